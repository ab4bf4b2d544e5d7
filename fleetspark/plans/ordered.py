"""Running values over long sequences, without one task per key.

A window over `vehicle_id` puts every reading of a vehicle into one task. When one vehicle holds
a third of all rows that task never ends, so keys above a row budget are cut into blocks of
consecutive arrival offsets. Each block is scanned on its own, and what earlier blocks leave
behind is one row per block: a running maximum over those rows gives the carry that is joined
back. The result is exactly that of the uncut window. All running values of a stage share one scan
and one row of carries; what the scan and the carries read is stored first, so that deduplication,
parsing and earlier stages run once however many stages follow.

Keys are counted first (one narrow column, map-side combine). If no key exceeds the budget,
`block` is a void column and the plan is a plain window: one exchange, one sort. Otherwise
ordinary keys have `block` = null, form a single window partition and never match a carry. The
list of cut keys has at most total_rows / block_rows entries and is broadcast up to `MOST_BUSY`;
carries have no such bound and are joined without a hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from fleetspark.sources.paths import landed

BLOCK = "block"
BLOCK_ROWS = 1_000_000
MOST_BUSY = 100_000
# A slice of the busiest key holds a thousandth of it, should that exceed the row budget.
MOST_CUTS = 1_000


def busy_keys(df: DataFrame, keys: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Keys with more than `block_rows` rows; counted with a map-side combine."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > block_rows)
        .select(*keys, F.lit(block_rows).cast("long").alias("_block_rows"))
    )


def _marked(df: DataFrame, busy: DataFrame, keys: list[str]) -> DataFrame | None:
    """`df` with what `busy` knows of its keys, or None where no key is busy."""
    number = busy.limit(MOST_BUSY + 1).count()
    if not number:
        return None
    return df.join(F.broadcast(busy) if number <= MOST_BUSY else busy, keys, "left")


def uncut(df: DataFrame) -> DataFrame:
    """Mark a frame whose keys all fit one task, for example a size-capped micro-batch."""
    return df.withColumn(BLOCK, F.lit(None))


def cut_by_offset(
    df: DataFrame,
    keys: list[str],
    *,
    block_rows: int | None = BLOCK_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add `block`: offset ranges for busy keys, null for the others.

    Offsets are unique within a partition, so a block never holds more than `block_rows` rows.
    `counted` may be a cheaper frame to count keys on (a superset of `df`'s rows); `block_rows`
    None means that the caller bounds the input already.
    """
    if block_rows is None:
        return uncut(df)
    busy = busy_keys(df if counted is None else counted, keys, block_rows)
    marked = _marked(df, busy, keys)
    if marked is None:
        return uncut(df)
    # Null for keys that are not busy, because `_block_rows` is.
    number = F.shiftleft(F.col("partition").cast("long"), 32) + F.expr("offset div _block_rows")
    return marked.withColumn(BLOCK, number).drop("_block_rows")


def cut_by_time(
    df: DataFrame, keys: list[str], time: str, *, block_rows: int | None = BLOCK_ROWS
) -> DataFrame:
    """Add `block` for sequences without offsets: time slices for busy keys, null otherwise.

    A busy key is cut at quantiles of its times, from a sketch per key, so slices hold about
    `block_rows` rows in a burst as well as in a lull; rows of one instant stay together.
    """
    if block_rows is None:
        return uncut(df)
    at = F.unix_micros(time)
    counted = busy_keys(df, keys, block_rows)
    most = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).agg(F.max("_rows")).first()[0]
    if most is None or most <= block_rows:
        return uncut(df)
    # All busy keys get the cuts that the busiest one needs; smaller ones skip most of them below.
    pieces = min(-(-most // block_rows), MOST_CUTS)
    shares = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
    cuts = (
        df.join(counted.select(*keys), keys, "left_semi")
        .groupBy(*keys)
        .agg(F.percentile_approx(at, shares, F.lit(20 * pieces)).alias("_cuts"), F.count(F.lit(1)).alias("_rows"))
        .select(
            *keys,
            F.filter(
                "_cuts",
                lambda cut, i: (i + 1) % F.greatest(F.lit(1), F.floor(F.lit(pieces * block_rows) / F.col("_rows"))) == 0,
            ).alias("_cuts"),
        )
    )
    marked = _marked(df, cuts, keys)
    if marked is None:
        return uncut(df)
    passed = F.size(F.filter("_cuts", lambda cut: cut < at)).cast("long")
    return marked.withColumn(BLOCK, F.when(F.col("_cuts").isNotNull(), passed)).drop("_cuts")


def running_max(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    before: dict[str, Column] | None = None,
    through: dict[str, Column] | None = None,
) -> DataFrame:
    """Add running maxima per key in `order`: over earlier rows, or through the current row.

    Nulls are skipped. A maximum of struct(order..., payload) is "the newest payload", so lag,
    last-non-null and as-of lookups are all running maxima. Where keys are cut the input is stored,
    because the scan and the carries both read it.
    """
    before, through = before or {}, through or {}
    values = {**before, **through}
    whole = isinstance(df.schema[BLOCK].dataType, NullType)
    span = Window.partitionBy(*keys, *([] if whole else [BLOCK])).orderBy(*order)
    earlier = span.rowsBetween(Window.unboundedPreceding, -1)
    so_far = span.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if whole:
        return df.withColumns(
            {
                **{name: F.max(value).over(earlier) for name, value in before.items()},
                **{name: F.max(value).over(so_far) for name, value in through.items()},
            }
        )

    df = landed(df, "scan")
    blocks = Window.partitionBy(*keys).orderBy(BLOCK)
    past_blocks = blocks.rowsBetween(Window.unboundedPreceding, -1)

    carries = (
        df.where(F.col(BLOCK).isNotNull())
        .groupBy(*keys, BLOCK)
        .agg(*[F.max(value).alias(name) for name, value in values.items()])
        .select(
            *keys, BLOCK, *[F.max(name).over(past_blocks).alias(f"_past_{name}") for name in values]
        )
    )
    local = df.withColumns(
        {
            **{f"_here_{name}": F.max(value).over(earlier) for name, value in before.items()},
            **{f"_here_{name}": F.max(value).over(so_far) for name, value in through.items()},
        }
    )
    return (
        local.join(carries, [*keys, BLOCK], "left")
        .withColumns({n: F.greatest(f"_here_{n}", f"_past_{n}") for n in values})
        .drop(*[f"_{side}_{n}" for side in ("here", "past") for n in values])
    )
