"""Cutting a batch of records into flushes of bounded rows and bytes (ST6).

Only partition, offset and payload size are shuffled. Offsets are dealt to blocks, and within a
block running sums of bytes and rows cut it into runs of a quarter of a flush at most, half of one
in bytes; a record above a quarter of the byte limit is a run by itself. What the driver packs
into flushes, in offset order of each partition, is one row a run: at most some eight runs a flush,
each of which is a snapshot to commit anyway.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.settings import StreamOptions

SHARE = 4


@dataclass(frozen=True)
class Run:
    """Consecutive records of a partition; `delivered` counts repeated offsets too."""

    partition: int
    block: int
    first: int
    last: int
    rows: int
    bytes: int
    delivered: int


def block_of(offset: str, options: StreamOptions):
    return F.expr(f"{offset} div {options.rows}")


def runs_of(records: DataFrame, options: StreamOptions) -> DataFrame:
    """The runs of Kafka-shaped records, one row each; equal offsets count once."""
    most_bytes, most_rows = max(1, options.bytes // SHARE), max(1, options.rows // SHARE)
    sizes = (
        records.select(
            "partition", "offset", F.coalesce(F.octet_length("value"), F.lit(0)).alias("size")
        )
        .withColumn("block", block_of("offset", options))
        .repartition("partition", "block")
        .groupBy("partition", "block", "offset")
        .agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("copies"))
        .withColumn("large", F.col("size") > most_bytes)
    )
    before = (
        Window.partitionBy("partition", "block")
        .orderBy("offset")
        .rowsBetween(Window.unboundedPreceding, -1)
    )

    def so_far(value):
        return F.coalesce(F.sum(value).over(before), F.lit(0))

    placed = sizes.select(
        "*",
        so_far(F.col("large").cast("int")).alias("_large"),
        F.floor(so_far(F.when(~F.col("large"), F.col("size"))) / most_bytes).alias("_bytes"),
        F.floor(so_far(F.lit(1)) / most_rows).alias("_rows"),
    )
    # A large record does not move the byte count, so what stands on its two sides is told apart.
    return placed.groupBy("partition", "block", "large", "_large", "_bytes", "_rows").agg(
        F.min("offset").alias("first"),
        F.max("offset").alias("last"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("size").alias("bytes"),
        F.sum("copies").alias("delivered"),
    ).select(*Run.__dataclass_fields__)


def packed(runs: list[Run], options: StreamOptions) -> list[list[Run]]:
    """Runs as flushes within both limits; only a single record may exceed the bytes.

    Partitions take turns, so that a flush holds a stretch of each, as records arrive.
    """
    place: dict[int, int] = {}
    turns = []
    for run in sorted(runs, key=lambda r: (r.partition, r.first)):
        turns.append((place.get(run.partition, 0), run.partition, run))
        place[run.partition] = turns[-1][0] + 1
    flushes: list[list[Run]] = []
    rows = size = 0
    for _, _, run in sorted(turns, key=lambda t: t[:2]):
        if not flushes or rows + run.rows > options.rows or size + run.bytes > options.bytes:
            flushes.append([])
            rows = size = 0
        flushes[-1].append(run)
        rows, size = rows + run.rows, size + run.bytes
    return flushes


def with_flush(records: DataFrame, flushes: list[list[Run]], options: StreamOptions, first: int, partition: str, offset: str) -> DataFrame:
    """Add `snapshot`, the number of each record's flush counted from `first`.

    The runs, which the driver holds already, are broadcast.
    """
    if len(flushes) == 1:
        return records.withColumn("snapshot", F.lit(first).cast("long"))
    marks = records.sparkSession.createDataFrame(
        [(r.partition, r.block, r.first, r.last, first + n) for n, runs in enumerate(flushes) for r in runs],
        "_partition int, _block long, _first long, _last long, snapshot long",
    )
    own = (
        (F.col(partition) == F.col("_partition"))
        & (block_of(offset, options) == F.col("_block"))
        & F.col(offset).between(F.col("_first"), F.col("_last"))
    )
    return records.join(F.broadcast(marks), own).select(*records.columns, "snapshot")
