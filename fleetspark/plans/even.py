"""Even tasks for work that costs much a row, such as making or validating JSON.

Spark cuts files by compressed bytes and never cuts a row group, and a topic has few partitions: a
table of millions of narrow records can come in fewer tasks than there are cores, or in tasks whose
time grows with the table. Moving the raw rows costs little beside parsing them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TASK_ROWS = 200_000
SHUFFLE_ROWS = 50_000


def even_tasks(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS) -> int:
    """Whole rounds over all cores, at most `task_rows` rows a task."""
    cores = spark.sparkContext.defaultParallelism
    return cores * max(1, -(-rows // (cores * task_rows)))


def in_even_tasks(df: DataFrame, rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """`df`, of some `rows` rows, in even tasks."""
    return df.repartition(even_tasks(df.sparkSession, rows, task_rows))


@contextmanager
def partitions_for_rows(spark: SparkSession, rows: int, task_rows: int = SHUFFLE_ROWS) -> Iterator[None]:
    """At most as many shuffle partitions as some `rows` rows fill, in whole rounds over all cores.

    A stored frame keeps the number it was made with, and each task that writes it leaves a file.
    """
    name = "spark.sql.shuffle.partitions"
    configured = spark.conf.get(name)
    spark.conf.set(name, str(min(int(configured), even_tasks(spark, rows, task_rows))))
    try:
        yield
    finally:
        spark.conf.set(name, configured)
