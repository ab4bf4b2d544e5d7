"""Batch accounting, latency and backlog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.times import moment, seconds_between
from fleetspark.operators.dedup import dedup_first, drop_seen
from fleetspark.operators.detect import DEFAULTS, detect, new_rows
from fleetspark.operators.validate import valid_readings
from fleetspark.plans.ordered import BLOCK_ROWS
from fleetspark.settings import DetectorSettings

OUTCOMES = ["consumed", "accepted", "duplicates", "invalid", "late", "alerts"]


def sum_of_parts(parts: list[DataFrame], columns: list[str]) -> DataFrame:
    """One row from one-row frames that each know some of the columns."""
    filled = [
        part.select(
            *[F.col(c) if c in part.columns else F.lit(0).cast("long").alias(c) for c in columns]
        )
        for part in parts
    ]
    rows = filled[0]
    for part in filled[1:]:
        rows = rows.unionByName(part)
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])


def batch_outcomes(
    parsed: DataFrame,
    seen: DataFrame | None = None,
    settings: DetectorSettings = DEFAULTS,
    *,
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """What became of parsed records: consumed = accepted + duplicates + invalid.

    `parsed` is read three times (keys, intake, detection): give it as a stored table, such as
    the archive, or land it first.
    """
    readings = valid_readings(parsed)
    unique = dedup_first(readings)
    if seen is not None:
        unique = drop_seen(unique, seen)
    detected = new_rows(detect(unique, settings, block_rows=block_rows, counted=readings))
    intake = parsed.agg(
        F.count(F.lit(1)).alias("consumed"), F.count_if(~F.col("valid")).alias("invalid")
    )
    outcome = detected.agg(
        F.count(F.lit(1)).alias("accepted"),
        F.count_if("late").alias("late"),
        F.sum(F.size("opened_types")).alias("alerts"),
    )
    totals = sum_of_parts([intake, outcome], [c for c in OUTCOMES if c != "duplicates"])
    duplicates = F.col("consumed") - F.col("invalid") - F.col("accepted")
    return totals.withColumn("duplicates", duplicates).select(*OUTCOMES)


def event_latency(readings: DataFrame, as_of) -> DataFrame:
    """Age in milliseconds of the newest reading, never negative."""
    age = seconds_between(F.max("timestamp"), moment(as_of)) * 1000.0
    return readings.agg(F.greatest(F.lit(0.0), age).alias("event_latency_ms"))


def partition_lag(offsets: DataFrame) -> DataFrame:
    """Backlog over partitions of (partition, high, committed); no commit counts from zero."""
    committed = F.greatest(F.coalesce("committed", F.lit(0)), F.lit(0))
    return offsets.agg(F.sum(F.greatest(F.lit(0), F.col("high") - committed)).alias("lag"))
