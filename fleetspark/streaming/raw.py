"""Streaming jobs without detection: the raw archive and rolling activity (ST5, ST7)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetspark.schema import ACTIVITY
from fleetspark.settings import StreamOptions
from fleetspark.sources.archive import append_archive, open_archive, resume_offsets
from fleetspark.streaming.buckets import read_buckets, write_buckets
from fleetspark.streaming.live import wall_clock
from fleetspark.streaming.sources import flush_rule


def start_archive(
    records: DataFrame,
    root: str,
    topic: str,
    checkpoint: str,
    options: StreamOptions = StreamOptions(),
    *,
    clock: Callable[[], datetime] = wall_clock,
    drain: bool = False,
    retained: DataFrame | None = None,
) -> StreamingQuery:
    """Archive every record; the archive's own offsets make a repeated batch harmless (ST5).

    With `retained` (partition, low, high) of the source, an archive whose next offset is no longer
    there stops before it starts, instead of leaving a gap (S2).
    """
    if retained is not None:
        open_archive(records.sparkSession, root, topic, create=True)
        resume_offsets(records.sparkSession, root, retained).collect()

    def commit(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            append_archive(batch, root, topic, clock(), options=options)
        finally:
            batch.unpersist()

    writer = (
        records.writeStream.queryName("archive")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(commit)
    )
    return flush_rule(writer, options, drain=drain).start()


def activity_stream(readings: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Readings and mean speed per minute and scenario, kept up to date (ST7).

    Equals the batch report as long as no reading is later than `lateness`; a minute that no
    reading can reach any more leaves the state.
    """
    return (
        readings.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", "1 minute"), "event_type")
        .agg(F.count(F.lit(1)).alias("events"), F.avg("speed_kmh").alias("average_speed_kmh"))
        .select(
            F.col("window.start").alias("minute"), "event_type", "events", "average_speed_kmh"
        )
    )


def _day_of_minute():
    return F.floor(F.unix_seconds("minute") / 86_400).cast("long")


def upsert_activity(changed: DataFrame, root: str, batch_id: int) -> None:
    """Put the groups that a batch changed into the table; only their days are rewritten (ST7)."""
    changed = changed.persist()
    try:
        days = [row["day"] for row in changed.select(_day_of_minute().alias("day")).distinct().collect()]
        if not days:
            return
        stored = read_buckets(changed.sparkSession, root, "activity", ACTIVITY, batch_id, days)
        others = stored.join(changed.select("minute", "event_type"), ["minute", "event_type"], "left_anti")
        rows = changed.select(*ACTIVITY.fieldNames()).unionByName(others.select(*ACTIVITY.fieldNames()))
        write_buckets(rows, _day_of_minute(), root, "activity", batch_id, days)
    finally:
        changed.unpersist()


def read_activity(spark: SparkSession, root: str) -> DataFrame:
    """Every minute and scenario so far, evicted from the stream's state or not (ST7)."""
    return read_buckets(spark, root, "activity", ACTIVITY)


def start_activity(
    readings: DataFrame,
    root: str,
    checkpoint: str,
    lateness: str = "1 hour",
    options: StreamOptions = StreamOptions(),
    *,
    drain: bool = False,
) -> StreamingQuery:
    """Keep the activity table of a stream of readings; changes alone leave the aggregate (ST7)."""

    def commit(batch: DataFrame, batch_id: int) -> None:
        upsert_activity(batch, root, batch_id)

    writer = (
        activity_stream(readings, lateness)
        .writeStream.queryName("activity")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(commit)
    )
    return flush_rule(writer, options, drain=drain).start()
