"""Drawn rows follow their rates, keep all columns, and need no shuffle of texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetspark.llm import mixing, queries
from fleetspark.llm.common import table

SF = "/root/testdata/sf0.001"


def test_each_row_as_often_as_its_rate_asks(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    docs = docs.withColumns({"row": F.lit(1), "text_key": F.col("doc_id") * 2, "p_0": F.lit("x"), "tokens": F.lit(None).cast("int")})
    drawn = mixing.draw(docs, labels, queries.MIX_WEIGHTS)
    assert drawn.columns == docs.columns
    chance = F.pmod(F.xxhash64("doc_id", F.xxhash64("text"), F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    rates = mixing.mix(docs, labels, queries.MIX_WEIGHTS).select("doc_id", "rate").join(docs, "doc_id")
    wanted = {r["doc_id"]: r["n"] for r in rates.select("doc_id", F.floor(F.col("rate") + chance).alias("n")).collect()}
    found = {r["doc_id"]: r["count"] for r in drawn.groupBy("doc_id").count().collect()}
    assert found == {k: n for k, n in wanted.items() if n} and 0 in wanted.values()
    assert drawn.where("text_key <> doc_id * 2 OR p_0 <> 'x' OR tokens IS NOT NULL").count() == 0
    assert "Exchange" not in drawn._jdf.queryExecution().executedPlan().toString()


def test_odd_rows(spark):
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, "word " * 3000, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words int")
    labels, even = table(spark, SF, "labels").limit(0), dict.fromkeys(queries.MIX_WEIGHTS, 1.0)
    assert sorted(map(tuple, mixing.draw(docs, labels, even).collect()), key=repr) == sorted(rows, key=repr)
    assert mixing.draw(docs.limit(0), labels, even).count() == 0
