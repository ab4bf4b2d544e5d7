"""Phrase mining against counting every phrase, with slices of any size."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from fleetspark.llm import phrases
from fleetspark.llm.common import restored, restored_steps, squeezed, squeezed_steps


def brute_force(rows, longest, least, top):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    found = []
    for lang, f in counts.items():
        known = {p: a for p, a in f.items() if a >= least}
        scored = []
        for phrase, a in known.items():
            if len(phrase) < 2:
                continue
            inside = any(
                b >= a and len(q) > len(phrase) and any(q[i : i + len(phrase)] == phrase for i in range(len(q)))
                for q, b in known.items()
            )
            if inside:
                continue
            cuts = [(1000 * a * n[lang] // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(found)


def texts(seed: int):
    dice = random.Random(seed)
    vocabulary = ["the", "New", "york", "city", "hall", "Été", "über", "a\x85b", "x\x1cy"]
    rows = []
    for _ in range(120):
        words = dice.choices(vocabulary, k=dice.randrange(30))
        if dice.random() < 0.6:
            words[2:2] = ["New", "York", "City", "Hall", "steps"]
        rows.append(("".join(w + dice.choice([" ", "  ", "\t", ", ", ".", "\n"]) for w in words), dice.choice(["en", "fr", None])))
    return [*rows, (None, "en"), ("", None), ("aha aha aha aha", "en"), ("," * 40, "de")]


@pytest.mark.parametrize("slice_words", [1, 200, 4_000_000])
def test_every_phrase(spark, slice_words):
    rows = texts(slice_words % 7)
    frame = spark.createDataFrame([(*r, 5, "z") for r in rows], "text string, lang string, a int, slice string").repartition(3)
    found = phrases.collocations(frame, longest=4, least=4, top=25, slice_words=slice_words)
    wanted = brute_force(rows, 4, 4, 25)
    assert sorted(map(tuple, found.collect())) == wanted and len(wanted) > 20


def test_nothing_frequent(spark):
    frame = spark.createDataFrame([("a b c", "en"), (None, None)], "text string, lang string")
    assert phrases.collocations(frame).count() == 0
    assert phrases.collocations(frame.limit(0)).count() == 0
    assert phrases.collocations(frame, least=1).select("lang", "phrase").collect() == [("en", "a b c")]


def test_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BUCKET_WORDS", 2)
    monkeypatch.setattr(phrases, "BUCKET_GROUPS", 5)
    rows = texts(4)
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    found = phrases.collocations(frame, longest=4, least=4, top=25, slice_words=100)
    assert sorted(map(tuple, found.collect())) == brute_force(rows, 4, 4, 25)


def test_a_slice_sends_few_bytes_a_group_to_even_buckets():
    """400,000 of the pairs of 100,000 words, a tenth of them with one frequent word in front."""
    dice = np.random.default_rng(5)
    left = np.where(np.arange(400_000) < 40_000, 77, dice.integers(100_000, size=400_000))
    keys = np.unique(left * 100_000 + dice.integers(100_000, size=400_000))
    counts = dice.geometric(0.6, len(keys))
    row = {"slice": 3, "keys": squeezed_steps(keys), "counts": squeezed(counts, "<i8")}
    [sent] = phrases._dealt(49)([pa.RecordBatch.from_pylist([row])])
    sent = sent.to_pylist()
    back = np.concatenate([restored_steps(x["keys"]) * 49 + x["bucket"] for x in sent])
    order = np.argsort(back)
    assert np.array_equal(back[order], keys)
    assert np.array_equal(np.concatenate([restored(x["counts"], "<i8") for x in sent])[order], counts)
    sizes = [len(restored_steps(x["keys"])) for x in sent]
    assert len(sizes) == 49 and max(sizes) < 1.1 * min(sizes)
    assert sum(len(x["keys"]) + len(x["counts"]) for x in sent) < 4 * len(keys)
