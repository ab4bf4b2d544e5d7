"""The bounded recent sample: take, publish, read, check (A4, J8, S10, S11, T5, U1, U2, ST9)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.functions.times import minus_seconds, moment, month_of
from fleetspark.plans.paging import check_between, check_vehicle, distinct_ids
from fleetspark.schema import SAMPLE
from fleetspark.settings import SampleScope
from fleetspark.sources.paths import child_names, delete, read_text, replace_text

SAMPLE_READING = ["event_id", "vehicle_id", "fleet_id", "timestamp", "speed_kmh", "event_type"]
POINTER = "CURRENT"


def _utc(as_of: datetime) -> datetime:
    return as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)


def recent_snapshot(history: DataFrame, as_of, scope: SampleScope = SampleScope()) -> DataFrame:
    """Newest readings of the lowest vehicle ids within the window, capped by the scope (T5)."""
    now = moment(as_of)
    first = minus_seconds(now, scope.window_minutes * 60)
    rows = history.where(
        F.col("vehicle_id").between("V000001", f"V{scope.vehicle_limit:06d}")
        & (F.length("vehicle_id") == 7)  # longer ids are larger numbers, whatever their first digits
        & F.col("timestamp").between(first, now)
    )
    if "month" in history.columns:
        rows = rows.where(F.col("month").between(month_of(first), month_of(now)))
    newest = rows.select(*SAMPLE_READING).orderBy(F.desc("timestamp"), "event_id")
    return newest.limit(scope.row_limit)


def with_scope(sample: DataFrame, as_of: datetime, scope: SampleScope = SampleScope()) -> DataFrame:
    """The sample and one metadata row, so an empty sample still tells its age.

    The metadata row has empty texts, a null time and speed zero.
    """
    spark = sample.sparkSession
    empty = {"timestamp": F.lit(None).cast("timestamp"), "speed_kmh": F.lit(0.0)}
    meta = spark.range(1).select(
        *[empty.get(name, F.lit("")).alias(name) for name in SAMPLE_READING]
    )
    scoped = {
        "snapshot_epoch": F.lit(_utc(as_of).timestamp()),
        "window_minutes": F.lit(scope.window_minutes),
        "vehicle_limit": F.lit(scope.vehicle_limit),
        "row_limit": F.lit(scope.row_limit),
    }
    return sample.select(*SAMPLE_READING).unionByName(meta).withColumns(scoped)


def publish_snapshot(rows: DataFrame, directory: str, as_of: datetime, keep: int = 2) -> str:
    """Write a new version, check it by reading it back, then point readers to it.

    The pointer is swapped by one rename. Any failure before that leaves the old version current.
    """
    spark = rows.sparkSession
    version = f"{int(_utc(as_of).timestamp() * 1_000_000):020d}"
    target = f"{directory}/versions/{version}"
    # The row cap keeps this small: one file.
    rows.coalesce(1).write.mode("overwrite").parquet(target)
    stored = spark.read.schema(SAMPLE).parquet(target)
    if stored.where(F.col("event_id") == "").count() != 1:
        raise ValueError("published sample must hold exactly one metadata row")
    replace_text(spark, f"{directory}/{POINTER}", version)
    for old in child_names(spark, f"{directory}/versions")[:-keep]:
        if old < version:
            delete(spark, f"{directory}/versions/{old}")
    return version


def read_snapshot(spark: SparkSession, directory: str) -> DataFrame:
    """The published version, metadata row included."""
    version = read_text(spark, f"{directory}/{POINTER}")
    if version is None:
        raise ValueError("no sample has been published")
    return spark.read.schema(SAMPLE).parquet(f"{directory}/versions/{version.strip()}")


def snapshot_view(spark: SparkSession, directory: str, name: str = "recent_telemetry") -> None:
    """Register the published version as a temporary view."""
    read_snapshot(spark, directory).createOrReplaceTempView(name)


def refresh_snapshot(
    history: DataFrame, directory: str, as_of: datetime, scope: SampleScope = SampleScope()
) -> str:
    """Take and publish in one re-runnable step (ST9)."""
    return publish_snapshot(
        with_scope(recent_snapshot(history, as_of, scope), as_of, scope), directory, as_of
    )


def assert_fresh(snapshot: DataFrame, as_of: datetime, max_age: int = 120):
    """The metadata row, or an error when it is missing or too old (ST9)."""
    check_between("max_age", max_age, 1, 600)
    meta = snapshot.where(F.col("event_id") == "").first()
    if meta is None:
        raise ValueError("sample metadata is missing")
    if meta["snapshot_epoch"] < _utc(as_of).timestamp() - max_age:
        raise ValueError("recent sample is stale")
    return meta


def recent_sample(
    snapshot: DataFrame,
    vehicle_ids: list[str],
    minutes: int,
    as_of: datetime,
    max_age: int = 120,
) -> DataFrame:
    """Count, mean speed and time span per asked vehicle, with the sample's scope (A4).

    Arguments, freshness and scope are checked before the plan is built; the metadata row is the
    only one that reaches the driver.
    """
    ids = distinct_ids(vehicle_ids)
    check_between("number of vehicles", len(ids), 1, 8)
    check_between("minutes", minutes, 1, 60)
    for vehicle_id in ids:
        check_vehicle(vehicle_id)
    meta = assert_fresh(snapshot, as_of, max_age)
    if any(not 1 <= int(v[1:]) <= meta["vehicle_limit"] for v in ids):
        raise ValueError("vehicle lies outside the sample")
    if minutes > meta["window_minutes"]:
        raise ValueError("sample window is shorter than the requested minutes")
    since = minus_seconds(moment(as_of), minutes * 60)
    scope = ["snapshot_epoch", "window_minutes", "vehicle_limit", "row_limit"]
    return (
        snapshot.where(F.col("vehicle_id").isin(ids) & (F.col("timestamp") >= since))
        .groupBy("vehicle_id")
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.avg("speed_kmh").alias("average_speed_kmh"),
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
        )
        .withColumns({name: F.lit(meta[name]) for name in scope})
        .orderBy("vehicle_id")
    )


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many keys two tables share, and how many only one of them has.

    Both sides are reduced to one row per key before the join.
    """
    a = left.groupBy(key).agg(F.count(F.lit(1)).alias("_left"))
    b = right.groupBy(key).agg(F.count(F.lit(1)).alias("_right"))
    both = a.join(b, key, "full_outer")
    in_left, in_right = F.col("_left").isNotNull(), F.col("_right").isNotNull()
    return both.agg(
        F.count_if(in_left & in_right).alias("in_both"),
        F.count_if(in_left & ~in_right).alias("only_left"),
        F.count_if(~in_left & in_right).alias("only_right"),
        F.coalesce(F.sum("_left"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_right"), F.lit(0)).alias("right_rows"),
    )


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one frame has more often than the other, with the side they are on.

    One pass: rows of one side count up, those of the other down, and what is not zero differs.
    """
    columns = a.columns
    both = a.withColumn("_sign", F.lit(1)).unionByName(b.select(*columns).withColumn("_sign", F.lit(-1)))
    surplus = both.groupBy(*columns).agg(F.sum("_sign").alias("_more")).where("_more <> 0")
    times = F.expr("array_repeat(if(_more > 0, 'left', 'right'), cast(abs(_more) as int))")
    return surplus.select(*columns, F.explode(times).alias("side"))


def assert_same_rows(a: DataFrame, b: DataFrame) -> None:
    """Raise unless both frames hold the same rows, in any order."""
    if not differing_rows(a, b).isEmpty():
        raise AssertionError("the two results differ")
