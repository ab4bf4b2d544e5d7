"""Keyed tables in buckets that only the batches which touch them rewrite (S8, ST7).

    <root>/<table>/version=<n>/bucket=<b>          buckets that batch n wrote
    <root>/<table>_versions/version=<n>/BUCKETS    the version that holds each bucket after batch n

A version exists once its list does, which is renamed into place. A batch reads the buckets its
keys fall into, merges, and writes these again; all others stay where they are.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetspark.schema import STATE
from fleetspark.sources.paths import child_names, delete, exists, read_text, replace_text

STATE_BUCKETS = 64
KEPT_VERSIONS = 3


def bucket_versions(spark: SparkSession, root: str, table: str) -> list[int]:
    path = f"{root}/{table}_versions"
    names = [n for n in child_names(spark, path) if exists(spark, f"{path}/{n}/BUCKETS")]
    return sorted(int(name.split("=")[1]) for name in names)


def _listed(spark: SparkSession, root: str, table: str, version: int) -> dict[int, int]:
    listed = json.loads(read_text(spark, f"{root}/{table}_versions/version={version}/BUCKETS"))
    return {int(bucket): holder for bucket, holder in listed.items()}


def _newest(spark: SparkSession, root: str, table: str, before: int | None) -> dict[int, int]:
    versions = [v for v in bucket_versions(spark, root, table) if before is None or v < before]
    return _listed(spark, root, table, versions[-1]) if versions else {}


def read_buckets(
    spark: SparkSession,
    root: str,
    table: str,
    schema: StructType,
    before: int | None = None,
    buckets: list[int] | None = None,
) -> DataFrame:
    """Rows of the newest version, or the newest before a batch; of some buckets or all."""
    holders = _newest(spark, root, table, before)
    paths = [
        f"{root}/{table}/version={version}/bucket={bucket}"
        for bucket, version in sorted(holders.items())
        if buckets is None or bucket in buckets
    ]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def write_buckets(
    rows: DataFrame, bucket: Column, root: str, table: str, batch_id: int, buckets: list[int]
) -> None:
    """Write the whole of the touched buckets, then the version, and drop what none needs.

    Files of the last `KEPT_VERSIONS` versions stay, for a restart and for readers.
    """
    spark, version = rows.sparkSession, int(batch_id)
    holders = {**_newest(spark, root, table, version), **{b: version for b in buckets}}
    (
        rows.withColumn("bucket", bucket)
        .repartition("bucket")
        .write.mode("overwrite")
        .partitionBy("bucket")
        .option("compression", "zstd")
        .parquet(f"{root}/{table}/version={version}")
    )
    replace_text(spark, f"{root}/{table}_versions/version={version}/BUCKETS", json.dumps(holders))
    versions = bucket_versions(spark, root, table)
    kept = versions[-KEPT_VERSIONS:]
    needed = {(v, b) for k in kept for b, v in _listed(spark, root, table, k).items()}
    for name in child_names(spark, f"{root}/{table}"):
        old = int(name.split("=")[1])
        held = {b for v, b in needed if v == old}
        if old >= kept[0]:
            continue
        if not held:
            delete(spark, f"{root}/{table}/{name}")
            continue
        for inner in child_names(spark, f"{root}/{table}/{name}"):
            if int(inner.split("=")[1]) not in held:
                delete(spark, f"{root}/{table}/{name}/{inner}")
    for old in versions[:-KEPT_VERSIONS]:
        delete(spark, f"{root}/{table}_versions/version={old}")


def state_bucket() -> Column:
    """A vehicle's bucket of the state table."""
    return F.pmod(F.xxhash64("vehicle_id"), F.lit(STATE_BUCKETS)).cast("int")


def read_state(
    spark: SparkSession, root: str, before: int | None = None, buckets: list[int] | None = None
) -> DataFrame:
    """Latest states of all vehicles, or of those in some buckets; the newest before a batch."""
    return read_buckets(spark, root, "state", STATE, before, buckets)


def write_state(state: DataFrame, root: str, batch_id: int, buckets: list[int]) -> None:
    """Write the states of all vehicles in the buckets that a batch touched."""
    write_buckets(state.select(*STATE.fieldNames()), state_bucket(), root, "state", batch_id, buckets)
