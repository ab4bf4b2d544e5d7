"""History tables on Parquet: layout, replacing reads, retention, compaction.

Layout: `<table>/batch_id=<n>/month=<yyyymm>/*.parquet`. A batch always writes to its own
directory, so repeating a batch replaces exactly its own rows, and `read_final` collapses rows
that reached two batches. Folded months of batches up to n lie in
`<table>_folded/batch_id=<n>/fold=<k>/month=<yyyymm>`, which no batch ever writes to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.functions.times import minus_seconds, moment, month_of
from fleetspark.plans.paging import check_days, check_fleet
from fleetspark.schema import ALERT, ENRICHED
from fleetspark.settings import RETENTION_DAYS
from fleetspark.sources.paths import child_names, delete, exists

TABLES = {"telemetry": ENRICHED, "alerts": ALERT}
TELEMETRY_KEYS = ["vehicle_id", "timestamp", "event_id"]
ALERT_KEYS = ["vehicle_id", "timestamp", "alert_id"]
KEYS = {"telemetry": TELEMETRY_KEYS, "alerts": ALERT_KEYS}
DAY_SECONDS = 86_400


def cluster_by_vehicle(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range by (vehicle, time) and sort, so file statistics prune vehicle lookups (M4).

    Time is part of the range key: one busy vehicle spreads over many files.
    """
    keys = ["vehicle_id", "timestamp"]
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *keys)
    return ranged.sortWithinPartitions(*keys)


def write_bucketed(rows: DataFrame, path: str, name: str, table: str = "telemetry", buckets: int = 64) -> DataFrame:
    """A history table in buckets by vehicle, sorted by vehicle and time, as catalog table `name` (M4).

    Reports by vehicle, the replacing read and joins by vehicle of such tables need no exchange.
    The rows move once, when they are written: one file a bucket.
    """
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[table].fields])
    (
        typed.withColumn("month", month_of(F.col("timestamp")))
        .repartition(buckets, "vehicle_id")
        .write.mode("overwrite")
        .bucketBy(buckets, "vehicle_id")
        .sortBy("vehicle_id", "timestamp")
        .option("compression", "zstd")
        .option("path", path)
        .saveAsTable(name)
    )
    return rows.sparkSession.table(name)


def read_bucketed(spark: SparkSession, path: str, name: str, table: str = "telemetry", buckets: int = 64) -> DataFrame:
    """The same table in a session whose catalog does not know it yet."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES[table].fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, month int) USING parquet "
        f"CLUSTERED BY (vehicle_id) SORTED BY (vehicle_id, timestamp) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def write_partitioned(
    df: DataFrame, path: str, by: list[str], *, mode: str = "overwrite", compression: str = "zstd"
) -> None:
    """Parquet by derived partition columns (M3)."""
    df.write.mode(mode).partitionBy(*by).option("compression", compression).parquet(path)


def write_history(rows: DataFrame, root: str, table: str, batch_id: int) -> None:
    """Write one batch of a history table; repeating it is harmless (S7, ST4)."""
    if table not in TABLES:
        raise ValueError(f"unsupported history table {table!r}")
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[table].fields])
    write_partitioned(
        typed.withColumn("month", month_of(F.col("timestamp"))),
        f"{root}/{table}/batch_id={int(batch_id)}",
        ["month"],
    )


def read_history(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Every stored row of a table, with `batch_id` and `month`; empty when nothing is stored.

    Folded rows have the number of the last batch folded.
    """
    schema = T.StructType(
        TABLES[table].fields
        + [T.StructField("batch_id", T.LongType()), T.StructField("month", T.IntegerType())]
    )
    parts = [
        spark.read.schema(schema).option("basePath", path).parquet(path).select(*schema.fieldNames())
        for path in (f"{root}/{table}", f"{root}/{table}_folded")
        if exists(spark, path)
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _number(name: str) -> int:
    return int(name.split("=")[1])


def _month_folders(spark: SparkSession, root: str, table: str) -> list[str]:
    """Month folders below `root`: folded ones first, then by rising batch."""
    found = []
    for batch in sorted(child_names(spark, f"{root}/{table}_folded"), key=_number):
        for fold in child_names(spark, f"{root}/{table}_folded/{batch}"):
            inside = f"{table}_folded/{batch}/{fold}"
            found += [f"{inside}/{m}" for m in child_names(spark, f"{root}/{inside}") if "month=" in m]
    for batch in sorted(child_names(spark, f"{root}/{table}"), key=_number):
        inside = f"{table}/{batch}"
        found += [f"{inside}/{m}" for m in child_names(spark, f"{root}/{inside}") if "month=" in m]
    return found


def read_final(df: DataFrame, keys: list[str], order: str = "batch_id") -> DataFrame:
    """Last write wins per key.

    Vehicle and time are keys, so filters on them pass below the window to the scan, and copies
    of a key are pruned before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def in_window(
    df: DataFrame, as_of, days: int, fleet_id: str | None = None, time: str = "timestamp"
) -> DataFrame:
    """Rows of the last `days` days, optionally of one fleet.

    A stored table also gets the matching month predicate, which prunes directories; the time
    predicate alone would not.
    """
    cutoff = minus_seconds(moment(as_of), check_days(days) * DAY_SECONDS)
    rows = df.where(F.col(time) >= cutoff)
    if "month" in df.columns:
        rows = rows.where(F.col("month") >= month_of(cutoff))
    if check_fleet(fleet_id) is not None:
        rows = rows.where(F.col("fleet_id") == fleet_id)
    return rows


def _oldest(as_of, days: int) -> Column:
    return minus_seconds(moment(as_of), days * DAY_SECONDS)


def apply_retention(df: DataFrame, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows still inside the retention period (M1)."""
    rows = df.where(F.col("timestamp") >= _oldest(as_of, days))
    return rows.where(F.col("month") >= month_of(_oldest(as_of, days))) if "month" in df.columns else rows


def drop_expired_months(
    spark: SparkSession, root: str, table: str, as_of, days: int = RETENTION_DAYS
) -> list[str]:
    """Delete month directories that lie wholly before the retention period (M1)."""
    first_kept = spark.range(1).select(month_of(_oldest(as_of, days)).alias("m")).first()["m"]
    dropped = []
    for folder in _month_folders(spark, root, table):
        if _number(folder.rsplit("/", 1)[1]) < first_kept:
            delete(spark, f"{root}/{folder}")
            dropped.append(folder.removeprefix(f"{table}/"))
    return dropped


def compact_month(spark: SparkSession, root: str, table: str, month: int, batch_id: int) -> None:
    """Fold a month of all batches up to `batch_id`, earlier folds included, into one (M2).

    The fold has a folder of its own, so a restarted stream that repeats a batch cannot overwrite
    rows of others; `read_final` collapses what it repeats. Folded rows equal what `read_final`
    picks, and what they replace is deleted after they are written, older folds and batches first,
    so a crash at any point leaves a table that reads the same.
    """
    replaced = [
        folder
        for folder in _month_folders(spark, root, table)
        if folder.endswith(f"/month={int(month)}") and _number(folder.split("/")[1]) <= batch_id
    ]
    if not replaced:
        return
    stored = read_history(spark, root, table).where(
        (F.col("month") == month) & (F.col("batch_id") <= batch_id)
    )
    folded = cluster_by_vehicle(read_final(stored, KEYS[table]).drop("batch_id", "month"))
    target = f"{root}/{table}_folded/batch_id={int(batch_id)}"
    fold = 1 + max([_number(name) for name in child_names(spark, target)], default=0)
    folded.write.option("compression", "zstd").parquet(f"{target}/fold={fold}/month={int(month)}")
    for folder in replaced:
        delete(spark, f"{root}/{folder}")
