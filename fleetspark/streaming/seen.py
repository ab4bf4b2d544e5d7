"""Ids accepted within the last day, by hour and id hash (ST2).

    <root>/seen/hour=<h>/part=<batch or fold>/bucket=<b>     event_id, accepted_at, batch_id

A batch looks its ids up in the hours that still count and in the buckets its ids fall into; the
batch's ids travel to the stored ones, not the other way round, so a day of ids is read but never
shuffled. Rows of the batch itself, left by an attempt that failed, do not count. Past hours are
folded into one part, and hours that no longer count are deleted.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.functions.times import moment
from fleetspark.settings import DEDUP_HOURS
from fleetspark.sources.paths import child_names, delete, exists

BUCKETS = 16
MOST_BROADCAST = 2_000_000
_SCHEMA = "event_id string, accepted_at timestamp, batch_id long, hour long, part string, bucket int"


def _bucket() -> Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(BUCKETS)).cast("int")


def _hour(at: datetime) -> int:
    return int(at.timestamp()) // 3600


def _number(name: str) -> int:
    return int(name.split("=")[1])


def seen_ids(spark: SparkSession, root: str, batch_id: int, as_of: datetime, hours: int = DEDUP_HOURS) -> DataFrame:
    """Ids that earlier batches accepted and that still count, with their bucket."""
    path = f"{root}/seen"
    if not exists(spark, path):
        return spark.createDataFrame([], _SCHEMA)
    stored = spark.read.schema(_SCHEMA).option("basePath", path).parquet(path)
    oldest = F.timestamp_micros(F.unix_micros(moment(as_of)) - hours * 3_600_000_000)
    return stored.where(
        (F.col("hour") >= _hour(as_of) - hours)
        & (F.col("accepted_at") > oldest)
        & (F.col("batch_id") < batch_id)
    )


def drop_seen_ids(
    readings: DataFrame,
    root: str,
    batch_id: int,
    as_of: datetime,
    hours: int = DEDUP_HOURS,
    *,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Readings of a batch, ids distinct, without those whose id still counts as seen.

    Ids are read on their own first; `stored` may be a frame that holds them all and costs less.
    """
    ids = (readings if stored is None else stored).select("event_id", _bucket().alias("bucket"))
    known = ids.groupBy("bucket").count().collect()  # at most one row a bucket
    if not known:
        return readings
    if sum(row["count"] for row in known) <= MOST_BROADCAST:
        ids = F.broadcast(ids)
    seen = seen_ids(readings.sparkSession, root, batch_id, as_of, hours)
    seen = seen.where(F.col("bucket").isin([row["bucket"] for row in known]))
    return readings.join(seen.join(ids, ["event_id", "bucket"], "left_semi").select("event_id"), "event_id", "left_anti")


def write_seen(readings: DataFrame, root: str, batch_id: int, as_of: datetime) -> None:
    """Store the ids a batch accepted; a repeated batch replaces its own."""
    rows = readings.select(
        "event_id", moment(as_of).alias("accepted_at"), F.lit(batch_id).cast("long").alias("batch_id"),
        _bucket().alias("bucket"),
    )
    rows.repartition("bucket").sortWithinPartitions("bucket", "event_id").write.mode("overwrite").partitionBy("bucket").parquet(
        f"{root}/seen/hour={_hour(as_of)}/part={int(batch_id)}"
    )


def tidy_seen(spark: SparkSession, root: str, as_of: datetime, hours: int = DEDUP_HOURS) -> None:
    """Fold past hours into one part each and drop hours that no longer count.

    A fold is written before what it replaces goes; ids that are there twice in between do no harm.
    """
    now = _hour(as_of)
    for name in child_names(spark, f"{root}/seen"):
        path, hour = f"{root}/seen/{name}", _number(name)
        parts = child_names(spark, path)
        if hour < now - hours:
            delete(spark, path)
        elif hour < now and len(parts) > 1:
            fold = "part=fold" + str(1 + max((int(p[9:]) for p in parts if p.startswith("part=fold")), default=0))
            stored = spark.read.schema(_SCHEMA).option("basePath", path).parquet(path)
            stored.drop("hour", "part").dropDuplicates(["event_id", "batch_id"]).repartition("bucket").sortWithinPartitions(
                "bucket", "event_id"
            ).write.partitionBy("bucket").parquet(f"{path}/{fold}")
            for part in parts:
                delete(spark, f"{path}/{part}")
