"""Phrase collocations by relational mining of sorted occurrences.

Relation R1 holds every word occurrence by piece and position (its breaks included, so that a place
in the slice is a position); R(k+1) joins Rk with itself where
piece and position are adjacent, counts its groups, and only occurrences of frequent groups stay
for the next length. Relations are persisted in slices of some millions of words of one language:
a slice is one row with its sorted positions and codes, so the merge join is a comparison of
neighbours. A position between two pieces belongs to no word, so nothing joins across pieces.

Counting is one exchange a length. Frequent groups are numbered almost densely, so a longer group is
one integer of the two it joins. Each slice deals its distinct groups with their counts to buckets of
a bounded number of groups, as one row of compressed steps a bucket, and equal groups meet there by
value. Those that are frequent in all go back to their slices in the same form. A word that stands
in a third of all places is one group a slice, and the groups it begins or ends go to all buckets.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import (
    Workspace, blobs, by_bucket, restored, restored_steps, sliced, squeezed, squeezed_steps,
)

LONGEST, LEAST, TOP = 5, 100, 2_000
SLICE_WORDS = 2_000_000
BUCKET_WORDS, BUCKET_GROUPS = 1 << 16, 1 << 20
BREAK = b"\xff"
# Fixed by the contract: letters to lower, characters that end a piece, white space in a piece.
FOLDED = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r",
    b"abcdefghijklmnopqrstuvwxyz " + BREAK * 10,
)
RELATION = "slice long, lang string, at binary, code binary, keys binary, counts binary, groups long"
EXTENDED = pa.schema(
    [
        ("slice", pa.int64()), ("lang", pa.string()), *((name, pa.binary()) for name in ("at", "code", "keys", "counts")),
        ("groups", pa.int64()),
    ]
)
DEALT = "bucket long, slice long, keys binary, counts binary"
FREQUENT = "slice long, keys binary, ids binary, key array<long>, id array<long>, a array<long>"
WORDS = "slice long, lang string, words array<binary>, code binary, n long"


class _Slice:
    """Word occurrences of one language while they are read."""

    def __init__(self):
        self.codes: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: list[bytes]) -> None:
        """Texts follow each other with a break between; breaks have the code -1."""
        joined = BREAK.join(texts).translate(FOLDED) + BREAK
        tokens = joined.replace(BREAK, b" " + BREAK + b" ").split()
        codes = self.codes
        for word in set(tokens) - codes.keys() - {BREAK}:
            codes[word] = len(codes)
        codes[BREAK] = -1
        self.parts.append(np.fromiter(map(codes.__getitem__, tokens), np.int32, len(tokens)))
        del codes[BREAK]
        self.size += len(tokens)

    def row(self, number: int, lang: str) -> pa.RecordBatch:
        code = np.concatenate(self.parts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), pa.array([lang]), pa.array([list(self.codes)], pa.list_(pa.binary())),
                pa.array([squeezed(code, "<i4")], pa.binary()), pa.array([int((code >= 0).sum())], pa.int64()),
            ],
            ["slice", "lang", "words", "code", "n"],
        )


def _occurrences(limit: int):
    """The words of whole texts in slices of at least `limit` tokens, but for the last."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_slices: dict[str, _Slice] = {}
        for batch in sliced(batches, "text"):
            texts = blobs(batch.column("text"))
            by_lang: dict[str, list[bytes]] = {}
            for text, lang in zip(texts, batch.column("lang").to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, some in by_lang.items():
                part = open_slices.setdefault(lang, _Slice())
                part.add(some)
                if part.size >= limit:
                    yield open_slices.pop(lang).row(number, lang)
                    number += 1
        for lang, part in open_slices.items():
            yield part.row(number, lang)
            number += 1

    return run


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            code = restored(row["code"], "<i4")
            counts = np.bincount(code[code >= 0], minlength=len(row["words"]))
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, row["slice"])), pa.array(np.arange(n, dtype=np.int64)),
                    pa.array([row["lang"]] * n, pa.string()), pa.array(row["words"], pa.binary()), pa.array(counts.astype(np.int64)),
                ],
                ["slice", "code", "lang", "word", "count"],
            )


def _dealt(buckets: int):
    """Each slice's groups and counts by bucket; a bucket's keys have the same remainder."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rest, bucket = np.divmod(restored_steps(row["keys"]), buckets)
                counts = restored(row["counts"], "<i8")
                filled, parts = by_bucket(bucket)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(filled), pa.array(np.full(len(filled), row["slice"], np.int64)),
                        pa.array([squeezed_steps(rest[part]) for part in parts], pa.binary()),
                        pa.array([squeezed(counts[part], "<i8") for part in parts], pa.binary()),
                    ],
                    ["bucket", "slice", "keys", "counts"],
                )

    return run


def _frequent(buckets: int, least: int):
    """One bucket: the groups with `least` occurrences in all, a row for each slice that holds any
    and one without a slice for all of them. An id is a place in the bucket times their number."""

    def run(dealt: pa.Table) -> pa.Table:
        bucket = dealt["bucket"][0].as_py()
        keys = [restored_steps(x) for x in dealt["keys"].to_pylist()]
        counts = np.concatenate([restored(x, "<i8") for x in dealt["counts"].to_pylist()])
        groups, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(groups), np.int64)
        np.add.at(total, place, counts)
        often = total >= least
        key = groups[often] * buckets + bucket
        number = (np.cumsum(often) - 1) * buckets + bucket
        rows = [(None, None, None, key, number[often], total[often])] if len(key) else []
        ends = np.cumsum([len(x) for x in keys])
        for slice_, some in zip(dealt["slice"].to_pylist(), np.split(place, ends[:-1])):
            some = some[often[some]]
            if len(some):
                rows.append((slice_, squeezed_steps(groups[some] * buckets + bucket), squeezed_steps(number[some]), None, None, None))
        kinds = (pa.int64(), pa.binary(), pa.binary(), *[pa.list_(pa.int64())] * 3)
        names = ("slice", "keys", "ids", "key", "id", "a")
        return pa.table({n: pa.array([row[i] for row in rows], k) for i, (n, k) in enumerate(zip(names, kinds))})

    return run


def _extend(stride: int):
    """One slice: its frequent occurrences joined with those at the next position. The key of a
    group is the id of what it begins with times `stride` and the id of what it ends with."""

    def run(relation: pa.Table, frequent: pa.Table) -> pa.Table:
        if not relation.num_rows or not frequent.num_rows:
            return EXTENDED.empty_table()
        row = relation.to_pylist()[0]
        if row["at"] is None:  # words, named by their codes
            codes, ids = frequent["code"].to_numpy(), frequent["id"].to_numpy()
        else:
            keys, ids = (np.concatenate([restored_steps(x) for x in frequent[name].to_pylist()]) for name in ("keys", "ids"))
            codes = np.searchsorted(restored_steps(row["keys"]), keys)
        order = np.argsort(ids)
        codes, ids = codes[order], ids[order]
        code = restored(row["code"], "<i4")
        # The last place is that of a break, whose code is -1.
        place = np.full(int(max(codes.max(), code.max(initial=0))) + 2, -1, np.int32)
        place[codes] = np.arange(len(codes), dtype=np.int32)
        dense = place[code]
        stays = np.flatnonzero(dense >= 0)
        at = stays if row["at"] is None else restored_steps(row["at"])[stays]
        dense = dense[stays]
        first = np.flatnonzero(np.diff(at) == 1)
        if not len(first):
            return EXTENDED.empty_table()
        pair = dense[first].astype(np.int64) * len(codes) + dense[first + 1]
        # Places are in order of ids, so groups are in order of keys.
        groups, joined = np.unique(pair, return_inverse=True)
        values = (
            squeezed_steps(at[first]), squeezed(joined, "<i4"),
            squeezed_steps(ids[groups // len(codes)] * stride + ids[groups % len(codes)]),
            squeezed(np.bincount(joined), "<i8"),
        )
        return pa.Table.from_arrays(
            [
                pa.array([row["slice"]], pa.int64()), pa.array([row["lang"]], pa.string()),
                *(pa.array([v], pa.binary()) for v in values), pa.array([len(groups)], pa.int64()),
            ],
            schema=EXTENDED,
        )

    return run


def frequent_phrases(ws: Workspace, docs: DataFrame, longest: int, least: int, slice_words: int) -> tuple[DataFrame, DataFrame]:
    """(lang, words, a, size) of phrases of 1 to `longest` words with a >= `least`; (lang, n)."""
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    relation = ws.land(texts.mapInArrow(_occurrences(slice_words), WORDS), "r1")
    sums = relation.agg(F.sum(F.size("words"))).first()
    totals = ws.land(relation.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    buckets = -(-(sums[0] or 1) // BUCKET_WORDS)
    each = Window.partitionBy("bucket", "lang", "word")
    ranked = Window.partitionBy("bucket").orderBy("lang", "word")
    frequent = ws.land(
        relation.select("slice", "lang", "words", "code")
        .mapInArrow(_word_counts, "slice long, code long, lang string, word binary, count long")
        .withColumn("bucket", F.pmod(F.xxhash64("lang", "word"), F.lit(buckets)))
        .repartition("bucket")
        .withColumn("a", F.sum("count").over(each))
        .where(F.col("a") >= least)
        .withColumn("id", (F.dense_rank().over(ranked) - 1) * F.lit(buckets) + F.col("bucket"))
        .select("slice", "code", "lang", "word", "a", "id"),
        "frequent-1",
    )
    # Ids are unique over all languages, so a group's key needs none.
    named = ws.land(
        frequent.dropDuplicates(["id"]).select("lang", "id", F.array("word").alias("words"), "a"), "phrases-1"
    )
    phrases = [named.withColumn("size", F.lit(1))]
    mine = ["code", "id"]
    for size in range(2, longest + 1):
        stride = (named.agg(F.max("id")).first()[0] or 0) + 1
        places = F.col("at") if size > 2 else F.lit(None).cast("binary").alias("at")
        keys = F.col("keys") if size > 2 else F.lit(None).cast("binary").alias("keys")
        relation = ws.land(
            relation.select("slice", "lang", places, "code", keys)
            .groupBy("slice")
            .cogroup(frequent.select("slice", *mine).groupBy("slice"))
            .applyInArrow(_extend(stride), RELATION),
            f"r{size}",
        )
        ws.drop(f"r{size - 1}", f"frequent-{size - 1}")
        buckets = -(-(relation.agg(F.sum("groups")).first()[0] or 1) // BUCKET_GROUPS)
        while math.gcd(buckets, stride) > 1:  # else what a frequent group ends would share a bucket
            buckets += 1
        everywhere = ws.land(
            relation.select("slice", "keys", "counts").mapInArrow(_dealt(buckets), DEALT)
            .groupBy("bucket")
            .applyInArrow(_frequent(buckets, least), FREQUENT),
            f"frequent-{size}",
        )
        frequent, mine = everywhere.where("slice IS NOT NULL"), ["keys", "ids"]
        found = everywhere.where("slice IS NULL").select(F.explode(F.arrays_zip("key", "id", "a")).alias("g")).select(
            F.expr(f"g.key div {stride}").alias("left"), (F.col("g.key") % F.lit(stride)).alias("right"), "g.id", "g.a"
        )
        left = named.select("lang", F.col("id").alias("left"), F.col("words").alias("start"))
        last = named.select(F.col("id").alias("right"), F.element_at("words", -1).alias("last"))
        named = ws.land(
            found.join(left, "left").join(last, "right")
            .select("lang", "id", F.concat("start", F.array("last")).alias("words"), "a"),
            f"phrases-{size}",
        )
        phrases.append(named.withColumn("size", F.lit(size)))
    ws.drop(f"r{longest}", f"frequent-{longest}")
    everything = phrases[0]
    for more in phrases[1:]:
        everything = everything.unionByName(more)
    return ws.land(everything.drop("id"), "phrases"), totals


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, slice_words: int = SLICE_WORDS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases.

    A null language is `und`, a null text is empty; repeated rows count again; an empty table, or
    one without a frequent phrase, gives an empty result. Other columns are ignored. A phrase that
    lies inside a longer one as frequent as itself is left out. Scores are exact: products are
    decimals of 38 digits, which hold a corpus of 10^17 words.
    """
    ws = Workspace(docs.sparkSession, "phrases")
    known, totals = frequent_phrases(ws, docs, longest, least, slice_words)
    longer = (
        known.where("size > 2")
        .withColumn("inner", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
        .withColumn("from", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("inner") + 1)))
        .groupBy("lang", F.slice("words", F.col("from"), F.col("inner")).alias("words"))
        .agg(F.max("a").alias("around"))
    )
    cuts = (
        known.where("size > 1")
        .join(longer, ["lang", "words"], "left")
        .where("around IS NULL OR 100 * around < 100 * a")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .withColumn("first", F.slice("words", F.lit(1), F.col("k")))
        .withColumn("rest", F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")))
        .join(known.select("lang", F.col("words").alias("first"), F.col("a").alias("l")), ["lang", "first"])
        .join(known.select("lang", F.col("words").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
        .join(totals, "lang")
        .withColumn(
            "score",
            F.expr(
                "(cast(a as decimal(17)) * cast(n as decimal(17)) * 1000) div (cast(l as decimal(19)) * cast(r as decimal(19)))"
            ),
        )
    )
    best = (
        cuts.groupBy("lang", "words", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select(
            "lang", F.array_join(F.transform("words", lambda w: w.cast("string")), " ").alias("phrase"),
            "a", "cut.l", "cut.r", "n", "cut.score",
        )
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
