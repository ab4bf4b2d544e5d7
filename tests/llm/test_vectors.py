"""Repeated rows and equal vectors in both searches."""

from __future__ import annotations

from fleetspark.llm import ann, kdtree


def test_repeated_rows_do_not_displace_equal_vectors(spark):
    rows = [(0, [1.0, 0.0])] * 15 + [(i, [1.0, 0.0]) for i in range(1, 13)] + [(20, [0.5, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(0, [1.0, 0.0])], vectors.schema)
    for found in (ann.nearest(vectors, asked), kdtree.top_k(vectors, asked)):
        assert [r["vec_id"] for r in found.orderBy("rank").collect()] == list(range(1, 11))
    twice = spark.createDataFrame(rows[15:27] * 2, vectors.schema)
    assert [r["vec_id"] for r in ann.nearest(twice, asked).orderBy("rank").collect()] == list(range(1, 11))
    assert [r["vec_id"] for r in kdtree.top_k(twice, asked).orderBy("rank").collect()] == [
        i for i in range(1, 6) for _ in range(2)]
