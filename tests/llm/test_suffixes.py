"""Repeated passages against brute force: whole rows, any group size, odd texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from fleetspark.llm import queries, suffixes
from fleetspark.llm.common import table

SF = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def brute_force(rows, length=200):
    """Every string of `length` bytes by value; bytes under one of two places or more go."""
    texts = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    found = []
    for doc_id, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if seen[text[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(text, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        found.append((doc_id, len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def results(frame):
    return sorted((tuple(row[c] for c in COLUMNS) for row in frame.collect()), key=repr)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    found = queries.QUERIES["op12_suffix_dedup"](spark, SF)
    assert sorted(found.columns) == sorted(COLUMNS)
    wanted = brute_force(rows)
    assert results(found) == wanted and any(r[2] for r in wanted)


def planted(seed: int):
    """Passages of about the length under random neighbours, some cut by a text's end."""
    dice = random.Random(seed)
    noise = lambda n: "".join(dice.choices("abc é\n", k=n))
    shared = [noise(n) for n in (190, 200, 201, 260, 420)]
    rows = []
    for i in range(60):
        parts = [noise(dice.randrange(120))]
        for _ in range(dice.randrange(4)):
            passage = dice.choice(shared)
            cut = dice.randrange(40) if dice.random() < 0.5 else 0
            parts += [passage[cut : len(passage) - dice.randrange(1 + cut)], noise(dice.randrange(90))]
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("group", [2, 7, 2_000])
def test_groups_of_any_size(spark, group):
    rows = planted(group)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert results(suffixes.remove_repeats(frame, group=group)) == brute_force(rows)


def test_odd_texts(spark):
    rows = [
        (None, "x" * 500), (None, None), (1, ""), (1, ""), (2, "short"), (3, "ab" * 150), (3, "ab" * 150),
        (4, "word " * 5_000), (5, "\0" * 200), (6, "\0" * 199), (7, "q" * 200), (8, "zero" + "\0" * 250),
        (9, "".join(random.Random(1).choices("abcdefgh", k=400))),
    ]
    frame = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id long, text string, row string, n_bytes int")
    assert results(suffixes.remove_repeats(frame)) == brute_force(rows)
    assert suffixes.remove_repeats(frame.limit(0)).count() == 0


def test_kept_bytes_are_the_digest(spark):
    frame = spark.createDataFrame(planted(1), "doc_id long, text string")
    for row in suffixes.remove_repeats(frame).collect():
        assert hashlib.sha256(bytes(row["kept"])).hexdigest() == row["kept_sha256"]
        assert len(row["kept"]) == row["n_bytes"] - row["n_removed"]


def test_blind_trie_sorts():
    dice = random.Random(3)
    keys = [dice.getrandbits(40) >> dice.randrange(3) << 4 for _ in range(300)] + [7, 7, 0]
    order, shared = suffixes.blind_trie(keys, 48)
    ranked = [keys[i] for i in order]
    assert ranked == sorted(keys) and sorted(order) == list(range(len(keys)))
    for a, b, common in zip(ranked, ranked[1:], shared[1:]):
        one, two = a.to_bytes(6, "big"), b.to_bytes(6, "big")
        assert common == next((i for i in range(6) if one[i] != two[i]), 6)


def test_sorted_suffixes_by_group():
    dice = np.random.default_rng(5)
    rows = dice.integers(0, 2, (500, 48)).astype(np.uint8)
    rows[:, :20] = 1
    rows[100:200, :46] = rows[100, :46]
    group = dice.integers(0, 4, 500)
    order, shared = suffixes.sorted_suffixes(rows, group)
    ranked = [(group[i], rows[i].tobytes()) for i in order]
    assert ranked == sorted(ranked)
    for (g, a), (h, b), common in zip(ranked, ranked[1:], shared[1:]):
        assert common == (-1 if g != h else next((i for i in range(48) if a[i] != b[i]), 48))
