"""JSON lines of readings (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetspark.schema import RECORD, TELEMETRY_COLUMNS


def read_json_lines(spark: SparkSession, path: str, topic: str = "file") -> DataFrame:
    """Text lines as records, ready for `parse_telemetry`.

    A file is a partition, numbered by rank of its path, and a line's number in it is its offset,
    however the files are split over tasks. Lines are counted per split first: that table has a
    row for each split, and the number of lines before a split makes positions line numbers.
    """
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))  # within the task
    placed = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        position.alias("_at"),
    )
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        placed.groupBy("_file", "_block")
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_lines"))
        .withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)))
        .withColumn("_rank", F.dense_rank().over(Window.orderBy("_file")) - 1)
    )
    return placed.join(splits, ["_file", "_block"]).select(
        F.lit(topic).alias("topic"),
        F.col("_rank").cast("int").alias("partition"),
        (F.col("_before") + F.col("_at") - F.col("_first")).alias("offset"),
        F.col("value").cast("binary").alias("value"),
        F.lit(-1).cast("long").alias("timestamp_ms"),
    ).select(*RECORD.fieldNames())


def write_json_lines(readings: DataFrame, path: str) -> None:
    """Readings as JSON lines that `read_json_lines` accepts: all keys present, zoned times."""
    timed = readings.withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )
    text = F.to_json(F.struct(*TELEMETRY_COLUMNS), {"ignoreNullFields": "false"})
    timed.select(text.alias("value")).write.mode("overwrite").text(path)
