"""What several operators share: reading, words, landing tables, and Arrow slices."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.sources.paths import delete, shared_dir

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """`doc_id` and `text` alone, a null text as the empty one; other columns cannot clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def in_fold(key: Column | str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves the remainder; a null key counts as inside."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == remainder, F.lit(True))


class Workspace:
    """Intermediate tables of one run, in the cluster's shared folder.

    `land` cuts lineage: a lost executor re-reads files. `drop` frees a table that nothing reads
    any more; what stays until the end is the caller's result.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/fleetspark/{name}-{uuid.uuid4().hex}"

    def land(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, f"{self.root}/{name}")


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: both methods of bytes know ASCII letters and ASCII white space only."""
    return text.lower().split()


def coded_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The words of `words_of` of all texts as places in a list of distinct ones, and each text's
    number of words; no word of a text is an object."""
    lower = pa.array(map(bytes.lower, texts), pa.large_binary()).view(pa.large_string())
    split = pc.ascii_split_whitespace(lower)
    coded = split.values.dictionary_encode()
    distinct = listed(coded.dictionary.view(pa.large_binary()))
    codes, ends = coded.indices.to_numpy(), split.offsets.to_numpy()
    if b"" in distinct:  # from white space at an end
        filled = codes != distinct.index(b"")
        codes, ends = codes[filled], np.concatenate([[0], np.cumsum(filled)])[ends]
    return codes, np.diff(ends).astype(np.int64), distinct


class WordHashes:
    @staticmethod
    def of(words: list[bytes]) -> np.ndarray:
        """64-bit hashes; words are told apart before, so that none is kept."""
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sliced(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `most` bytes of the column, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        piece = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) // most
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)
            # Arrow's pool keeps what is freed, and executors pay for the most that any worker held.
            pa.default_memory_pool().release_unused()


def listed(column: pa.Array) -> list:
    """Texts or bytes as a list, without a scalar of Arrow's for each."""
    return column.to_numpy(zero_copy_only=False).tolist()


def blobs(column: pa.Array) -> list[bytes | None]:
    """Texts as UTF-8 bytes, without decoding them."""
    return listed(column.cast(pa.large_binary()))


def squeezed(values: np.ndarray, kind: str) -> bytes:
    """Integers as compressed planes of their bytes: small ones take a byte or two."""
    planes = np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(len(values), -1).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def restored(value: bytes, kind: str) -> np.ndarray:
    count, width = int.from_bytes(value[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(value[8:], count * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, count).T).view(kind).reshape(-1)


def squeezed_steps(ascending: np.ndarray) -> bytes:
    return squeezed(np.diff(ascending, prepend=0), "<i8")


def restored_steps(value: bytes) -> np.ndarray:
    return np.cumsum(restored(value, "<i8"))


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The buckets that hold anything, and the places of each one's in order."""
    order = np.argsort(bucket, kind="stable")
    filled, first = np.unique(bucket[order], return_index=True)
    return filled, np.split(order, first[1:])


def write_once(df: DataFrame, ws: Workspace, *done: str) -> DataFrame:
    """The result as a table, after which the named tables go."""
    result = ws.land(df, "result")
    ws.drop(*done)
    return result
