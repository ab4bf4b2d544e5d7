"""Raw archive on Parquet with snapshots and offset checkpoints (S9, S12, S13, J7, P13, ST5).

    <root>/TOPIC                              the only topic this archive takes
    <root>/data/snapshot=<n>/received_day=*   rows of one append
    <root>/commits/snapshot=<n>               offsets per partition after that append

An append flushes by rows and bytes: it writes the rows of all its flushes in one job, then commits
them one after the other. A snapshot exists once its commit does. Snapshot numbers are consecutive,
so rows of an append that failed lie above the newest commit: readers never see them and the next
append removes them first.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.functions.times import moment
from fleetspark.operators.tables import write_partitioned
from fleetspark.operators.validate import to_archive_rows
from fleetspark.plans.even import in_even_tasks
from fleetspark.plans.flush import Run, packed, runs_of, with_flush
from fleetspark.plans.ordered import BLOCK, BLOCK_ROWS, running_max
from fleetspark.plans.paging import check_between, check_vehicle
from fleetspark.schema import ARCHIVE, ARCHIVE_COLUMNS
from fleetspark.settings import StreamOptions
from fleetspark.sources.paths import child_names, delete, exists, landed, read_text, replace_text

COMMIT = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("start_offset", T.LongType()),
        T.StructField("next_offset", T.LongType()),
        T.StructField("records", T.LongType()),
        T.StructField("invalid", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)
_SNAPSHOT = T.StructField("snapshot", T.LongType())
MOST_BROADCAST = 1_000_000


def open_archive(spark: SparkSession, root: str, topic: str, *, create: bool = False) -> None:
    """Check that the archive belongs to `topic`; claim it when new and `create` is set."""
    owner = read_text(spark, f"{root}/TOPIC")
    if owner is None:
        if not create:
            raise ValueError(f"no archive at {root}")
        replace_text(spark, f"{root}/TOPIC", topic)
    elif owner.strip() != topic:
        raise ValueError("archive belongs to another topic")


def current_snapshot(spark: SparkSession, root: str) -> int | None:
    """Number of the newest committed snapshot."""
    commits = f"{root}/commits"
    for name in reversed(child_names(spark, commits)):
        if exists(spark, f"{commits}/{name}/_SUCCESS"):
            return int(name.split("=")[1])
    return None


def checkpoints(spark: SparkSession, root: str, snapshot_id: int | None = None) -> DataFrame:
    """Offsets and totals per source partition as of a snapshot (default: the newest)."""
    snapshot_id = current_snapshot(spark, root) if snapshot_id is None else snapshot_id
    if snapshot_id is None:
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).parquet(f"{root}/commits/{_name(snapshot_id)}")


def _name(snapshot_id: int) -> str:
    # Padded so that a directory listing is in snapshot order.
    return f"snapshot={snapshot_id:012d}"


def past_checkpoint(records: DataFrame, saved: DataFrame) -> DataFrame:
    """Records at or past the saved offset of their partition.

    `saved` has one row per source partition, which bounds the broadcast.
    """
    known = F.broadcast(saved.select("partition", "next_offset"))
    fresh = records.join(known, "partition", "left").where(
        F.col("next_offset").isNull() | (F.col("offset") >= F.col("next_offset"))
    )
    return fresh.select(*records.columns)


def first_of_equal(records: DataFrame, position: str | None = None) -> DataFrame:
    """One record per offset: the first at `position`, else by receive time, then payload.

    Offsets are counted without their payloads. Only payloads of repeated offsets are compared,
    and none is shuffled where, as on a healthy topic, no offset repeats.
    """
    key = ["partition", "offset"]
    repeated = landed(
        records.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*key), "repeated"
    )
    times = repeated.limit(MOST_BROADCAST + 1).count()
    if not times:
        return records
    if times <= MOST_BROADCAST:
        repeated = F.broadcast(repeated)
    order = [position] if position else [F.asc_nulls_last("timestamp_ms"), F.asc_nulls_last("value")]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    firsts = records.join(repeated, key, "left_semi").withColumn("_rank", rank).where("_rank = 1")
    return records.join(repeated, key, "left_anti").unionByName(firsts.drop("_rank"))


def skip_replayed(records: DataFrame, saved: DataFrame, position: str | None = None) -> DataFrame:
    """Records at or past the saved offset of their partition; one per offset."""
    return first_of_equal(past_checkpoint(records, saved), position)


def check_order(records: DataFrame, position: str) -> None:
    """Raise when offsets of a partition fall along `position`, the order of delivery.

    Long partitions are scanned in blocks of positions.
    """
    placed = records.select("partition", "offset", position).withColumn(
        BLOCK, F.expr(f"cast({position} div {BLOCK_ROWS} as bigint)")
    )
    rows = running_max(placed, ["partition"], [position], before={"_highest": F.col("offset")})
    if not rows.where(F.col("offset") < F.col("_highest")).isEmpty():
        raise ValueError("records of a partition must be in offset order")


def check_offset_range(saved: DataFrame) -> DataFrame:
    """Starting offset per (partition, saved, low, high); an offset out of retention raises."""
    inside = F.col("saved").between(F.col("low"), F.col("high"))
    lost = F.raise_error("saved offset lies outside the retained range").cast("long")
    start = F.when(F.col("saved").isNull(), F.col("low")).when(inside, F.col("saved"))
    return saved.select("partition", start.otherwise(lost).alias("start_offset"))


def resume_offsets(spark: SparkSession, root: str, retained: DataFrame) -> DataFrame:
    """Where a reader of (partition, low, high) goes on after the newest commit.

    A partition the archive has not seen starts at its low end. One whose saved offset is no longer
    retained, or lies above what there is, raises: records would be lost or belong to another topic.
    """
    saved = checkpoints(spark, root).select("partition", F.col("next_offset").alias("saved"))
    return check_offset_range(retained.join(F.broadcast(saved), "partition", "left"))


def append_archive(
    records: DataFrame,
    root: str,
    topic: str,
    as_of: datetime,
    *,
    options: StreamOptions = StreamOptions(),
    position: str | None = None,
) -> dict:
    """Append one batch and its offsets as new snapshots, one for each flush (S9, ST5, ST6).

    A flush holds at most `options.rows` records and `options.bytes` of payload; a single record
    above that is a flush by itself. Offsets already archived are skipped, so repeating a batch
    writes nothing and makes no snapshot. An error leaves the flushes committed so far, and
    repeating the batch continues after them.
    """
    spark = records.sparkSession
    open_archive(spark, root, topic, create=True)
    facts = records.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(~F.col("topic").eqNullSafe(topic)).alias("foreign"),
        F.count_if((F.col("partition") < 0) | (F.col("offset") < 0)).alias("negative"),
    ).first()
    if facts["foreign"]:
        raise ValueError("records of another topic")
    if facts["negative"]:
        raise ValueError("partition and offset must not be negative")
    if position is not None:
        check_order(records, position)

    newest = current_snapshot(spark, root)
    fresh = past_checkpoint(records, checkpoints(spark, root, newest))
    runs = [Run(*row) for row in runs_of(fresh, options).collect()]
    result = {"written": 0, "invalid": 0, "replayed": facts["records"], "snapshot_id": newest}
    if not runs:
        return result
    if sum(r.delivered for r in runs) > sum(r.rows for r in runs):
        fresh = first_of_equal(fresh, position)
    flushes, first = packed(runs, options), (newest or 0) + 1
    for name in child_names(spark, f"{root}/data"):
        if int(name.split("=")[1]) >= first:
            delete(spark, f"{root}/data/{name}")
    fresh = in_even_tasks(fresh, sum(r.rows for r in runs))
    rows = with_flush(
        to_archive_rows(fresh, as_of), flushes, options, first, "source_partition", "source_offset"
    )
    # Files of one day of one flush are few and of like size, however many tasks read the batch.
    write_partitioned(
        rows.hint("rebalance", "snapshot", "received_day"),
        f"{root}/data", ["snapshot", "received_day"], mode="append",
    )
    added = _commit(spark, root, first, first + len(flushes) - 1, as_of)
    result.update(added, replayed=facts["records"] - added["written"], snapshot_id=first + len(flushes) - 1)
    return result


def _commit(spark: SparkSession, root: str, first: int, last: int, as_of: datetime) -> dict:
    """Commit written snapshots in order: each adds its partitions' offsets to those before it."""
    written = _stored(spark, root).where(F.col("snapshot").between(first, last))
    added = written.groupBy("snapshot", F.col("source_partition").alias("partition")).agg(
        F.min("source_offset").alias("start_offset"),
        (F.max("source_offset") + 1).alias("next_offset"),
        F.count(F.lit(1)).alias("records"),
        F.count_if(~F.col("valid")).alias("invalid"),
    )
    known = {row["partition"]: row.asDict() for row in checkpoints(spark, root).collect()}
    by_snapshot: dict[int, list] = {}
    for row in added.collect():  # one row a flush and source partition
        by_snapshot.setdefault(row["snapshot"], []).append(row.asDict())
    for snapshot_id in range(first, last + 1):
        for new in by_snapshot[snapshot_id]:
            old = known.get(new["partition"])
            if old is not None:
                new = {
                    **new,
                    "start_offset": min(old["start_offset"], new["start_offset"]),
                    "records": old["records"] + new["records"],
                    "invalid": old["invalid"] + new["invalid"],
                }
            known[new["partition"]] = new
        rows = [tuple({**row, "committed_at": as_of}[name] for name in COMMIT.fieldNames()) for row in known.values()]
        commit = spark.createDataFrame(rows, COMMIT).coalesce(1)
        commit.write.mode("overwrite").parquet(f"{root}/commits/{_name(snapshot_id)}")
    new = [row for rows in by_snapshot.values() for row in rows]
    return {"written": sum(r["records"] for r in new), "invalid": sum(r["invalid"] for r in new)}


def _stored(spark: SparkSession, root: str) -> DataFrame:
    schema = T.StructType([*ARCHIVE.fields, _SNAPSHOT])
    return spark.read.schema(schema).option("basePath", f"{root}/data").parquet(f"{root}/data")


def read_archive(spark: SparkSession, root: str, snapshot_id: int | None = None) -> DataFrame:
    """The archive now or as of an earlier snapshot; an unknown snapshot is an error.

    The snapshot number is a directory, so older snapshots prune to their own files.
    """
    newest = current_snapshot(spark, root)
    if snapshot_id is None:
        snapshot_id = newest
    elif newest is None or not 1 <= snapshot_id <= newest:
        raise ValueError(f"snapshot {snapshot_id} does not exist")
    if snapshot_id is None:
        return spark.createDataFrame([], T.StructType([*ARCHIVE.fields, _SNAPSHOT]))
    return _stored(spark, root).where(F.col("snapshot") <= snapshot_id)


def query_archive(
    archive: DataFrame, vehicle_id: str, start: str, end: str, limit: int = 100
) -> DataFrame:
    """Valid readings of a vehicle in [start, end), without raw bytes, the first `limit`."""
    check_vehicle(vehicle_id)
    check_between("limit", limit, 1, 1000)
    lower, upper = datetime.fromisoformat(start), datetime.fromisoformat(end)
    if lower.tzinfo is None or upper.tzinfo is None or lower >= upper:
        raise ValueError("start and end must be zoned times in order")
    rows = archive.where(
        F.col("valid")
        & (F.col("vehicle_id") == vehicle_id)
        & (F.col("timestamp") >= moment(lower))
        & (F.col("timestamp") < moment(upper))
    )
    first = rows.orderBy("timestamp", "source_partition", "source_offset").limit(limit)
    return first.select(*[c for c in ARCHIVE_COLUMNS if c != "raw_payload"])


def archive_status(spark: SparkSession, root: str) -> DataFrame:
    """Offsets and totals per source partition, from the newest commit alone."""
    return checkpoints(spark, root).select(
        "partition", "start_offset", "next_offset", "records", "invalid"
    )


def archive_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Every snapshot with its commit time and total records."""
    schema = T.StructType([*COMMIT.fields, _SNAPSHOT])
    if current_snapshot(spark, root) is None:
        return spark.createDataFrame([], "snapshot long, committed_at timestamp, records long")
    commits = spark.read.schema(schema).option("basePath", f"{root}/commits")
    return (
        commits.parquet(f"{root}/commits")
        .groupBy("snapshot")
        .agg(F.max("committed_at").alias("committed_at"), F.sum("records").alias("records"))
    )
