"""Notices that repeat, differ in a word, stand together, or look alike; whole texts."""

from __future__ import annotations

import random

import pytest

from fleetspark.llm import licenses

SPLIT = {name: licenses.prepared(name, text) for name, text in licenses.TEMPLATES.items()}


def found(text: str) -> list[tuple]:
    return [(name, start, end) for name, _, start, end in licenses.matches(text.encode(), SPLIT) if name]


def test_repeated_and_changed_notices():
    line = "Released under the MIT License. "
    assert found("foo bar baz " + line * 2 + "qux") == [("MIT", 3, 8), ("MIT", 8, 13)]
    assert found(line * 50) == [("MIT", 5 * i, 5 * i + 5) for i in range(50)]
    # The word that is left out stands once elsewhere; the others are frequent.
    noise = "the license under released mit the. " * 3
    assert ("MIT", 418, 422) in found(noise + "x " * 200 + "and " * 200 + "under the MIT License. " + "y " * 50 + "released")


@pytest.mark.parametrize(
    "text, name",
    [
        ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0"),
        ("Licensed under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"),
        ("Licensed under CC BY-NC 3.0", None),
        ("Released under the BSD License", None),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0-line"),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0-line"),
    ],
)
def test_look_alikes(text, name):
    assert [n for n, _, _ in found(text)] == ([name] if name else [])


def test_several_notices_are_all_returned():
    text = "Released under the BSD License. Released under the MIT License. Licensed under CC BY 4.0."
    assert found(text) == [("MIT", 5, 10), ("CC-BY-4.0", 10, 16)]


@pytest.mark.parametrize("name", sorted(licenses.TEXTS))
def test_whole_text_without_its_start(name):
    body = licenses.TEXTS[name].split()
    body = body[len(body) // 10 :]
    assert name in [n for n, _, _ in found("intro " * 30 + " ".join(body) + " outro" * 30)]


def longest_common(a: list, b: list) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def some_words(dealt: random.Random, least: int, most: int, letters: int = 5) -> list[bytes]:
    return [bytes([97 + dealt.randrange(letters)]) for _ in range(dealt.randrange(least, most))]


def test_anchors_stand_once_and_ascend():
    a, b = b"the x one y two the z three one2".split(), b"one two the three the two2".split()
    assert licenses._anchors(a, b) == [(2, 0), (4, 1), (7, 3)]
    assert licenses.alignment(a, b) == [(2, 0), (4, 1), (5, 2), (7, 3)]


def test_alignment_ascends_and_halves_reach_the_longest_common_subsequence():
    dealt = random.Random(7)
    for _ in range(500):
        a, b = some_words(dealt, 1, 30, 9), some_words(dealt, 1, 16, 9)
        for late in (False, True):
            for halvings in range(len(b).bit_length() + 1):
                pairs = licenses.alignment(a, b, late, halvings)
                assert all(a[i] == b[j] for i, j in pairs)
                assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
            assert len(pairs) == longest_common(a, b)


def test_places_by_brute_force():
    dealt = random.Random(11)
    some = 0
    for _ in range(400):
        b = some_words(dealt, 4, 12)
        t = licenses.prepared("any", b" ".join(b).decode())
        a = some_words(dealt, 0, 40, 7)
        where = dealt.randrange(len(a) + 1)
        a[where:where] = b[: dealt.randrange(len(b) + 1)]
        found, width = list(licenses.places(a, t)), 2 * len(b)
        possible = any(longest_common(a[i : i + width], b) >= t.need for i in range(len(a)))
        assert bool(found) == possible
        some += possible
        assert all(x[2] <= y[1] for x, y in zip(found, found[1:]))
        for coverage, start, end in found:
            assert t.need <= round(coverage * len(b)) <= longest_common(a[start:end], b) and end - start <= width
        free = [0, *(p for place in found for p in place[1:]), len(a)]
        for low, high in zip(free[::2], free[1::2]):  # nothing is left between places
            assert longest_common(a[low:high][:width], b) < t.need or high - low > width
    assert 50 < some < 400


def test_scan_by_brute_force(spark):
    """Every text of the table: a notice without phrase rules is found where, and only where, a window
    of two lengths has it."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = ("BSD-start", "MIT-start")
    planted = [(-1, "a " * 9 + licenses.NOTICES["MIT-start"] + " b"), (-2, licenses.NOTICES["BSD-start"][20:])]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(planted, "doc_id long, text string"))
    rows = licenses.scan_licenses(docs, {name: licenses.NOTICES[name] for name in names}).collect()
    got = {(r["doc_id"], r["license"]) for r in rows if r["license"]}
    wanted = set()
    for row in docs.collect():
        found = licenses.words((row["text"] or "").encode())
        for name in names:
            t = SPLIT[name]
            # A window that holds a place starts at a word of the template.
            starts = [i for i, word in enumerate(found) if word in t.vocabulary]
            if any(
                len([w for w in found[i : i + 2 * t.length] if w in t.vocabulary]) >= t.need
                and longest_common(found[i : i + 2 * t.length], t.words) >= t.need
                for i in starts
            ):
                wanted.add((row["doc_id"], name))
    assert got == wanted and {(-1, "MIT-start"), (-2, "BSD-start")} <= got


def test_common_lengths_by_brute_force():
    dealt = random.Random(5)
    for _ in range(200):
        a, b = (some_words(dealt, 1, 12) for _ in range(2))
        masks = licenses.prepared("any", b" ".join(b).decode()).masks
        lengths = list(licenses.common_lengths(a, masks, len(b)))
        assert lengths == [longest_common(a[: i + 1], b) for i in range(len(a))]
