"""Streaming sources of Kafka-shaped records (S1, S2, ST6)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fleetspark.schema import RECORD
from fleetspark.settings import StreamOptions


@dataclass(frozen=True)
class KafkaSource:
    servers: str
    topic: str


@dataclass(frozen=True)
class FileSource:
    """Parquet files with the record columns, for replays and where no broker is.

    A batch takes `files_per_batch` files; or, where the writer kept files to `file_rows` records,
    as many as the stream's rows allow.
    """

    path: str
    files_per_batch: int = 1
    file_rows: int | None = None

    def files(self, options: StreamOptions) -> int:
        return max(1, options.rows // self.file_rows) if self.file_rows else self.files_per_batch


def read_telemetry_stream(
    spark: SparkSession,
    source: KafkaSource | FileSource,
    options: StreamOptions = StreamOptions(),
    *,
    fail_on_data_loss: bool = False,
) -> DataFrame:
    """Records from the earliest offset on, in batches of at most `options.rows`.

    The archive reads with `fail_on_data_loss`, so offsets that left retention stop it (S2).
    """
    if isinstance(source, FileSource):
        return (
            spark.readStream.schema(RECORD)
            .option("maxFilesPerTrigger", source.files(options))
            .parquet(source.path)
        )
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", source.servers)
        .option("subscribe", source.topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", options.rows)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
    )
    return raw.select(
        "topic", "partition", "offset", "value", F.unix_millis("timestamp").alias("timestamp_ms")
    )


def retained_offsets(spark: SparkSession, source: FileSource) -> DataFrame:
    """First offset there is and the one after the last, per partition of a file source."""
    return (
        spark.read.schema(RECORD)
        .parquet(source.path)
        .groupBy("partition")
        .agg(F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"))
    )


def flush_rule(
    writer: DataStreamWriter, options: StreamOptions, *, drain: bool = False
) -> DataStreamWriter:
    """Flush every `options.seconds`, or once through everything there is (ST6)."""
    if drain:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{options.seconds} seconds")
