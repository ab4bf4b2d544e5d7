"""Which rows stay when near duplicates are dropped."""

from __future__ import annotations

import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetspark.llm import near_dedup
from fleetspark.llm.common import coded_words, words_of


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_one_row_of_each_component_stays(spark, monkeypatch, most):
    """By a broadcast of the rows that go, and by a join."""
    monkeypatch.setattr(near_dedup, "MOST_BROADCAST", most)

    def said(name: str) -> str:
        return " ".join(f"{name}{i}" for i in range(40))

    rows = [
        (1, said("a"), "x"), (2, said("b"), "x"),
        (2, said("a"), "x"),  # a copy of 1; the other row of id 2 is unique
        (3, said("c"), "x"), (3, said("d"), "x"),  # one id, unlinked
        (None, said("b") + " tail", "x"),  # a near copy of the unique row of id 2
        (None, said("e"), "x"), (None, said("e"), "x"), (None, said("e") + " tail", "x"),
        (4, said("f"), "y"), (4, said("f"), "x"),
        (5, "", "x"), (5, None, "x"), (None, " ", "x"), (None, " ", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    docs = docs.withColumns({"row": F.lit(1), "mark": F.lit("m"), "root": F.lit(None).cast("int")})
    found = Counter((r[0], (r[1] or "")[:1].strip(), r[2]) for r in near_dedup.drop_near_duplicates(docs).collect())
    assert found == Counter({
        (1, "a", "x"): 1, (2, "b", "x"): 1, (3, "c", "x"): 1, (3, "d", "x"): 1, (None, "e", "x"): 1,
        (4, "f", "x"): 1, (5, "", "x"): 2, (None, "", "x"): 2,
    })


def test_a_worker_keeps_no_words():
    """100,000 words that never come back take some ten MB as kept hashes."""
    texts = [" ".join(f"w{i}x{j}" for j in range(1000)) for i in range(100)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(100)), "text_key": list(range(100)), "text": texts})
    list(near_dedup._sketched([batch.slice(0, 1)]))
    tracemalloc.start()
    assert sum(out.num_rows for out in near_dedup._sketched([batch])) == 100
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 1 << 20


def test_shingles_by_coded_words():
    texts = [b"", b" \n", b" a", b"a b c d ", b"\x0bA b\x0cC  d\te", b"a b c d e f", "É b c d e".encode(), b"\xff b c d e"]
    codes, counts, distinct = coded_words(texts)
    assert [distinct[code] for code in codes] == [word for text in texts for word in words_of(text)]
    assert counts.tolist() == [len(words_of(text)) for text in texts]
    sets = near_dedup.shingle_sets(texts)
    assert [len(one) for one in sets] == [0, 0, 1, 1, 1, 2, 1, 1] and sets[4][0] in sets[5]
