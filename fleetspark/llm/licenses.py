"""License notices and whole license texts by patience alignment.

Windows of the text that hold enough of a template's words, in any order, are aligned with it: words
that stand once on both sides are anchors, their longest increasing subsequence is kept, and the gaps
between anchors are aligned in the same way. A gap without anchors, or a window whose anchors were
misleading, is halved where the halves fit best. The place is what the alignment covers, grown while
aligned words outweigh the others. Words that tell licenses apart must stand in it as whole phrases.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from fleetspark.llm.common import blobs, id_text, sliced

# Notices of public licenses, whole texts in `license_texts`.
_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {} "
    "as published by the Free Software Foundation, either version {} of the License"
)
_GPL, _LGPL, _AGPL = "GNU General Public License", "GNU Lesser General Public License", "GNU Affero General Public License"
_CC = ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    **{f"CC-{kind}-4.0": f"Licensed under CC {kind} 4.0." for kind in _CC},
    "GPL-2.0-line": f"This work is licensed under the {_GPL}, version 2.",
    "GPL-3.0-line": f"This work is licensed under the {_GPL}, version 3.",
    "LGPL-3.0-line": f"This work is licensed under the {_LGPL}, version 3.",
    "AGPL-3.0-line": f"This work is licensed under the {_AGPL}, version 3.",
    "BSD-start": "Redistribution and use in source and binary forms, with or without modification, "
    "are permitted provided that the following conditions are met:",
    "GPL-2.0-header": _HEADER.format(_GPL, 2),
    "GPL-3.0-header": _HEADER.format(_GPL, 3),
    "LGPL-3.0-header": _HEADER.format(_LGPL, 3),
    "AGPL-3.0-header": _HEADER.format(_AGPL, 3),
    "MIT-start": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files",
}
TEXTS = {
    f"{path.stem}-text": path.read_text("utf-8")
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
}
TEMPLATES = {**NOTICES, **TEXTS}
# Phrases that a place must hold, and phrases that it must not.
REQUIRED = {
    "MIT": ["mit"],
    "Apache-2.0": ["apache", "2 0"],
    **{f"CC-{kind}-4.0": [f"cc {kind} 4 0"] for kind in _CC},
    **{f"{name}-{form}": [gnu, f"version {name[-3]}"] for form in ("line", "header") for name, gnu in (
        ("GPL-2.0", _GPL), ("GPL-3.0", _GPL), ("LGPL-3.0", _LGPL), ("AGPL-3.0", _AGPL))},
    "BSD-3-Clause-text": ["neither the name"],
}
EXCLUDED = {"BSD-2-Clause-text": ["neither the name"]}
LEAST_COVERAGE = 0.8
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


class Template(NamedTuple):
    words: list[bytes]
    need: int  # words that must be aligned
    counts: dict[bytes, int]
    vocabulary: frozenset[bytes]
    masks: dict[bytes, int]
    required: list[bytes]
    excluded: list[bytes]

    @property
    def length(self) -> int:
        return len(self.words)


def _masks(template: list[bytes]) -> dict[bytes, int]:
    """A word's places as bits."""
    masks: dict[bytes, int] = {}
    for i, word in enumerate(template):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


def prepared(name: str, text: str) -> Template:
    template = words(text.encode())
    required, excluded = (
        [b" %b " % b" ".join(words(p.encode())) for p in phrases.get(name, ())] for phrases in (REQUIRED, EXCLUDED)
    )
    need = math.ceil(LEAST_COVERAGE * len(template) - 1e-9)
    return Template(template, need, dict(Counter(template)), frozenset(template), _masks(template), required, excluded)


def common_lengths(found: list[bytes], masks: dict[bytes, int], length: int) -> Iterator[int]:
    """Length of the longest common subsequence with the template after each word. It bounds what any
    alignment reaches, one bit of an integer for each template word."""
    full = (1 << length) - 1
    free, aligned = full, 0
    for word in found:
        hit = free & masks.get(word, 0)
        if hit:
            free = ((free + hit) | (free - hit)) & full
            aligned = length - free.bit_count()
        yield aligned


def _anchors(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Places of words that stand once in both, as a longest sequence that ascends in both."""
    once = {word: j for j, word in enumerate(b)}
    times_b, times_a = Counter(b), Counter(word for word in a if word in once)
    pairs = [(i, once[w]) for i, w in enumerate(a) if times_a[w] == 1 and times_b[w] == 1]
    tops: list[int] = []  # the last template place of each pile
    piles: list[int] = []  # and its pair
    before: list[int] = []
    for n, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        before.append(piles[pile - 1] if pile else -1)
        tops[pile : pile + 1] = [j]
        piles[pile : pile + 1] = [n]
    chain, n = [], piles[-1] if piles else -1
    while n >= 0:
        chain.append(pairs[n])
        n = before[n]
    return chain[::-1]


def _cut(a: list[bytes], b: list[bytes], late: bool) -> int:
    """Where `a` is cut so that its parts align best with the halves of `b`."""
    half = len(b) // 2
    ahead = [0, *common_lengths(a, _masks(b[:half]), half)]
    behind = [0, *common_lengths(a[::-1], _masks(b[half:][::-1]), len(b) - half)][::-1]
    both = [x + y for x, y in zip(ahead, behind)]
    return len(a) - both[::-1].index(max(both)) if late else both.index(max(both))


def alignment(a: list[bytes], b: list[bytes], late: bool = False, halvings: int = 0) -> list[tuple[int, int]]:
    """Places of aligned words, ascending in both, by patience; after so many `halvings` of `b`.

    Ends of a gap that agree are aligned first. A choice between equal words falls on the first
    ones, or with `late` on the last ones, so that a place keeps to its anchors.
    """
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b), late, halvings, False)]
    while gaps:
        a0, a1, b0, b1, late, halvings, inner = gaps.pop()
        while inner and late and a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        while inner and a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while inner and a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        text, template = a[a0:a1], b[b0:b1]
        if not text or not template:
            continue
        chain = [] if halvings else _anchors(text, template)
        if chain:
            edges = [(a0 - 1, b0 - 1), *((a0 + i, b0 + j) for i, j in chain), (a1, b1)]
            pairs += edges[1:-1]
            for n, ((i, j), (k, m)) in enumerate(zip(edges, edges[1:])):
                if i + 1 < k and j + 1 < m:
                    gaps.append((i + 1, k, j + 1, m, n == 0 and late, 0, True))
        elif len(template) == 1:
            if template[0] in text:
                at = len(text) - 1 - text[::-1].index(template[0]) if late else text.index(template[0])
                pairs.append((a0 + at, b0))
        elif not set(text).isdisjoint(template):
            cut, half, rest = a0 + _cut(text, template, late), b0 + len(template) // 2, max(0, halvings - 1)
            # Between the halves words keep to the cut, at the outer ends to what follows or precedes.
            gaps += [(a0, cut, b0, half, late, rest, inner), (cut, a1, half, b1, False, rest, inner)]
    return sorted(pairs)


def _worth(count: int, first: int, last: int) -> int:
    """Each aligned word is worth two that are not."""
    return 3 * count - (last - first + 1)


def _place(found: list[bytes], low: int, after: int, t: Template) -> tuple[int, int, int]:
    """start, end and aligned words of the place in the window [low, after), which may grow.

    Halved down to single words, the window has its longest common subsequence, which is enough.
    """
    window = found[low:after]
    tries = (alignment(window, t.words, True, halvings) for halvings in range(t.length.bit_length() + 1))
    pairs = next(pairs for pairs in tries if len(pairs) >= t.need)
    # What the window left out on both sides of the alignment.
    (i, j), (k, m) = pairs[0], pairs[-1]
    ahead = max(low, low + i - 2 * j)
    before = alignment(found[ahead : low + i], t.words[:j], True)
    further = alignment(found[low + k + 1 : low + k + 1 + 2 * (t.length - m)], t.words[m + 1 :])
    at = [ahead + x for x, _ in before] + [low + x for x, _ in pairs] + [low + k + 1 + x for x, _ in further]
    own, width = len(before), 2 * t.length
    ends = [e for e in range(own + t.need - 1, len(at)) if at[e] - at[own] < width]
    last = max(ends, key=lambda e: (_worth(e - own + 1, at[own], at[e]), -e))
    starts = [s for s in range(last - t.need + 2) if at[last] - at[s] < width]
    first = max(starts, key=lambda s: (_worth(last - s + 1, at[s], at[last]), s))
    return at[first], at[last] + 1, last - first + 1


def places(found: list[bytes], t: Template) -> Iterator[tuple[float, int, int]]:
    """coverage, start, end (words, end exclusive) of the places of one template, by start."""
    hits = [i for i, w in enumerate(found) if w in t.counts]
    width = 2 * t.length
    left = right = overlap = 0
    inside: Counter = Counter()

    def drop_before(place: int) -> None:
        nonlocal left, right, overlap
        while left < len(hits) and hits[left] < place:
            if left < right:
                word = found[hits[left]]
                overlap -= inside[word] <= t.counts[word]
                inside[word] -= 1
            left += 1
        right = max(right, left)

    wanted = 0  # hits that must come in before a window can be aligned well enough
    while True:
        while (overlap < t.need or wanted > 0) and right < len(hits):
            at = hits[right]
            drop_before(at - width + 1)
            word = found[at]
            inside[word] += 1
            overlap += inside[word] <= t.counts[word]
            right, wanted = right + 1, wanted - 1
        if overlap < t.need or wanted > 0:
            return
        low, after = hits[left], hits[right - 1] + 1
        *_, bound = common_lengths(found[low:after], t.masks, t.length)
        if bound < t.need:  # each further hit adds one aligned word at most
            wanted = t.need - bound
            continue
        start, end, aligned = _place(found, low, after, t)
        said = b" %b " % b" ".join(found[start:end])
        sound = all(p in said for p in t.required) and not any(p in said for p in t.excluded)
        if sound:
            yield aligned / t.length, start, end
            drop_before(end)
        else:
            drop_before(start + 1)


def matches(text: bytes, templates: dict[str, Template]) -> list[tuple]:
    """license, coverage, start, end of every place of every template, or one row of none."""
    found = words(text)
    vocabulary = set(found)
    rows: list[tuple] = []
    for name, t in templates.items():
        # A word that the text lacks leaves one place of the template open at least.
        lacking = len(t.vocabulary) - len(t.vocabulary & vocabulary)
        if len(found) >= t.need and lacking <= t.length - t.need:
            rows += [(name, *place) for place in places(found, t)]
    return sorted(rows, key=lambda r: (r[2], r[3], r[0])) or [(None, 0.0, None, None)]


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, license, coverage, start, end: one row for each template and place that reaches the
    coverage, and one with a null license for a row without any.

    Null and empty texts cover nothing; repeated rows repeat their result. A whole text holds the
    place of its first sentence too, and similar licenses may each have a row for one place.
    """
    split = {name: prepared(name, text) for name, text in templates.items()}

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            each = [matches(text, split) for text in blobs(batch.column("text"))]
            owners = pa.array([i for i, rows in enumerate(each) for _ in rows], pa.int64())
            columns = zip(*(row for rows in each for row in rows))
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(owners), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["doc_id", "license", "coverage", "start", "end"],
            )

    return id_text(docs).mapInArrow(run, "doc_id long, license string, coverage double, start long, end long")
