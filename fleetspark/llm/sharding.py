"""Sharding by extendible hashing.

Rows have a 60-bit hash; the directory is indexed by its leading bits. Only buckets over the byte
limit are split on another bit, so every bucket has a depth of its own. Buckets are sized from a
histogram of prefixes that is deepened only under oversized prefixes; each deepening is one
aggregate. Rows with equal hashes cannot be told apart by more bits: such a bucket is cut into
pages of its rows instead, and a row above the limit stands alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import Workspace, id_text

BITS, DEEPER = 60, 6


def row_hash(*columns: str) -> Column:
    """The first 60 bits of the md5 of the columns' texts, as a long."""
    joined = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 15), 16, 10).cast("long")


def _prefix(depth: Column | int) -> Column:
    return F.expr("shiftrightunsigned(hash, 60 - depth)") if depth is None else F.shiftright("hash", BITS - depth)


def assign_shards(docs: DataFrame, limit: int) -> DataFrame:
    """doc_id, bytes, shard, depth, page, shard_bytes of every row.

    `bytes` is the UTF-8 length of the text, none for null. `shard` is the bucket's prefix written
    in bits, '' while everything fits one bucket; `page` is 0 but for rows of one hash that do not
    fit together. Rows that repeat id and text have one hash; an empty table has no shard.
    """
    ws = Workspace(docs.sparkSession, "sharding")
    rows = ws.land(
        id_text(docs).select(
            "doc_id", F.octet_length("text").cast("long").alias("bytes"), row_hash("doc_id", "text").alias("hash")
        ),
        "rows",
    )
    leaves, pending, start = [], None, 0
    while True:
        end = min(BITS, start + DEEPER)
        inside = rows
        if pending is not None:
            inside = rows.join(
                pending.select(F.col("prefix").alias("above")), F.shiftright("hash", BITS - start) == F.col("above"), "left_semi"
            )
        fine = ws.land(
            inside.groupBy(F.shiftright("hash", BITS - end).alias("fine")).agg(F.sum("bytes").alias("bytes")),
            f"fine-{end}",
        )
        nodes = fine.withColumn("depth", F.explode(F.sequence(F.lit(start), F.lit(end)))).groupBy(
            "depth", F.expr(f"shiftright(fine, {end} - depth)").alias("prefix")
        ).agg(F.sum("bytes").alias("bytes"))
        big = nodes.where(F.col("bytes") > limit).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
        )
        split = nodes.join(
            big, (nodes.depth == big.depth) & (F.shiftright(nodes.prefix, 1) == big.parent), "left_semi"
        )
        top = nodes.where(F.col("depth") == start) if start == 0 else nodes.limit(0)
        known = ws.land(top.unionByName(split), f"known-{end}")
        done = F.col("bytes") <= limit
        if end == BITS:
            leaves.append(known.where(done | (F.col("depth") == BITS)))
            break
        leaves.append(known.where(done))
        pending = ws.land(known.where(~done & (F.col("depth") == end)), f"pending-{end}")
        if pending.isEmpty():
            break
        start = end
    directory = leaves[0]
    for more in leaves[1:]:
        directory = directory.unionByName(more)
    directory = ws.land(directory, "directory")
    depths = [row["depth"] for row in directory.select("depth").distinct().collect()]  # at most 61
    candidates = F.explode(F.array(*map(F.lit, sorted(depths)))) if depths else F.explode(F.array(F.lit(0)))
    placed = (
        rows.withColumn("depth", candidates)
        .withColumn("prefix", F.expr(f"shiftright(hash, {BITS} - depth)"))
        .join(directory.withColumnRenamed("bytes", "shard_bytes"), ["depth", "prefix"])
    )
    return _paged(placed, limit).select(
        "doc_id", "bytes",
        F.when(F.col("depth") == 0, "")
        .otherwise(F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0")))
        .alias("shard"),
        "depth", "page", "shard_bytes",
    )


def _paged(placed: DataFrame, limit: int) -> DataFrame:
    """Rows of oversized buckets, which share one hash and so one size, are dealt to pages.

    Their number in each partition is counted first, then a row's place is its partition's offset
    plus its place there: no task sees a whole bucket.
    """
    over = (F.col("shard_bytes") > limit) & (F.col("depth") == BITS)
    plain = placed.where(~over).withColumn("page", F.lit(0).cast("long"))
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1024))
    crowded = placed.where(over).withColumn("part", part)
    counts = crowded.groupBy("hash", "part").agg(F.count("*").alias("n"))
    offsets = counts.select(
        "hash", "part",
        (F.sum("n").over(Window.partitionBy("hash").orderBy("part")) - F.col("n")).alias("before"),
    )
    place = F.row_number().over(Window.partitionBy("hash", "part").orderBy("bytes")) - 1
    paged = (
        crowded.withColumn("place", place)
        .join(offsets, ["hash", "part"])
        .withColumn("page", F.floor((F.col("before") + F.col("place")) / F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("bytes")))))
        .withColumn("shard_bytes", F.least(F.col("shard_bytes"), F.greatest("bytes", F.floor(F.lit(limit) / F.col("bytes")) * F.col("bytes"))))
        .select(*plain.columns[:-1], "page")
    )
    return plain.unionByName(paged)
