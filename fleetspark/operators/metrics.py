"""Counters over time: rates, means, heartbeats, progress.

Samples are a long table (source, instance_id, metric, ts, value, running).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.times import moment, seconds_between
from fleetspark.plans.ordered import BLOCK, BLOCK_ROWS, cut_by_time, running_max
from fleetspark.settings import REPORT_FRESH_SECONDS


def counter_increase(
    samples: DataFrame,
    series: list[str],
    *,
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """Add `increase` and `seconds` since the previous sample of each series.

    A value below the previous one is a restart from zero. First samples have nulls. Samples of one
    instant count by rising value, so that their order of delivery makes no restart.
    """
    rows = cut_by_time(samples, series, "ts", block_rows=block_rows)
    rows = running_max(rows, series, ["ts", "value"], before={"_last": F.struct("ts", "value")})
    last = F.col("_last.value")
    grown = F.when(F.col("value") < last, F.col("value")).otherwise(F.col("value") - last)
    return (
        rows.withColumn("increase", F.when(last.isNotNull(), grown))
        .withColumn("seconds", seconds_between(F.col("_last.ts"), F.col("ts")))
        .drop("_last", BLOCK)
    )


def counter_rate(
    samples: DataFrame,
    metric: str,
    *,
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """Per-second rate of a counter between its reports (D14, D18); all reports of an instant count."""
    counter = samples.where(F.col("metric") == metric)
    rows = (
        counter_increase(counter, ["source"], block_rows=block_rows)
        .groupBy("source", "ts")
        .agg(F.sum("increase").alias("increase"), F.max("seconds").alias("seconds"))
    )
    return rows.where(F.col("seconds") > 0).select(
        "source", "ts", (F.col("increase") / F.col("seconds")).alias("rate")
    )


def mean_duration(
    samples: DataFrame,
    total: str,
    count: str,
    by: list[str],
    *,
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """Mean of what happened between reports, per label: rate(total) / rate(count).

    The reporting interval is the same for both counters, so it cancels out.
    """
    rows = counter_increase(
        samples.where(F.col("metric").isin(total, count)),
        ["source", "metric"],
        block_rows=block_rows,
    )
    sums = rows.groupBy(*by, "ts").agg(
        F.sum(F.when(F.col("metric") == total, F.col("increase"))).alias("_total"),
        F.sum(F.when(F.col("metric") == count, F.col("increase"))).alias("_count"),
    )
    return sums.where(F.col("_count") > 0).select(
        *by, "ts", (F.col("_total") / F.col("_count")).alias("mean_duration")
    )


def label_totals(samples: DataFrame, metric: str, series: list[str], by: list[str]) -> DataFrame:
    """Newest value of every series, summed per label."""
    newest = (
        samples.where(F.col("metric") == metric)
        .groupBy(*dict.fromkeys([*series, *by]))
        .agg(F.max_by("value", "ts").alias("value"))
    )
    return newest.groupBy(*by).agg(F.sum("value").alias("total"))


def fresh_reports(samples: DataFrame, as_of, max_age: float = REPORT_FRESH_SECONDS) -> DataFrame:
    """Samples of running sources younger than `max_age` seconds.

    A stale or stopped report is left out; it never becomes a zero.
    """
    age = F.greatest(F.lit(0.0), seconds_between(F.col("ts"), moment(as_of)))
    running = F.coalesce(F.col("running"), F.lit(True))
    return samples.where((age < F.lit(float(max_age))) & running)


def heartbeats(samples: DataFrame, as_of, max_age: float = REPORT_FRESH_SECONDS) -> DataFrame:
    """Age of each source's newest report and whether it counts as reporting."""
    newest = samples.groupBy("source").agg(
        F.max(F.struct("ts", F.coalesce("running", F.lit(True)).alias("running"))).alias("last")
    )
    age = F.greatest(F.lit(0.0), seconds_between(F.col("last.ts"), moment(as_of)))
    return newest.select(
        "source",
        age.alias("heartbeat_age_seconds"),
        ((age < F.lit(float(max_age))) & F.col("last.running")).alias("reporting"),
    )


def progress_check(
    samples: DataFrame, metric: str, as_of=None, max_age: float = 15.0
) -> DataFrame:
    """First against last sample per source: did it advance, restart, go quiet."""
    end = F.struct("ts", "value", "instance_id")
    ends = (
        samples.where(F.col("metric") == metric)
        .groupBy("source")
        .agg(F.min(end).alias("first"), F.max(end).alias("last"))
    )
    advanced = F.col("last.value") > F.col("first.value")
    restarted = F.col("last.instance_id") != F.col("first.instance_id")
    age = seconds_between(F.col("last.ts"), moment(as_of)) if as_of is not None else F.lit(0.0)
    stale = (age < 0) | (age >= max_age)
    return ends.select(
        "source",
        F.col("first.value").alias("first_value"),
        F.col("last.value").alias("last_value"),
        advanced.alias("advanced"),
        restarted.alias("restarted"),
        stale.alias("stale"),
    )
