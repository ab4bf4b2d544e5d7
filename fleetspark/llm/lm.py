"""Language-model scores by a probabilistic suffix tree over the bytes of words.

A text is its lower-cased words, each closed by a space, then one end symbol. Contexts of up to
`DEPTH` bytes are kept when they occur often enough and their next-symbol distribution diverges
from that of their longest kept suffix. Distributions are smoothed towards that suffix's; a symbol
is predicted from the longest kept suffix before it. The model is a table for each depth and grows
with the corpus. Counts travel as compressed steps, a row for each bucket of keys, and are summed there
by key. Every distinct gram is scored once by joins with these tables, and texts look
their grams up. Only frequent grams and words are broadcast, to save joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import (
    GOLDEN,
    WordHashes,
    Workspace,
    blobs,
    by_bucket,
    coded_words,
    id_text,
    in_fold,
    mix,
    restored,
    restored_steps,
    sliced,
    squeezed,
    squeezed_steps,
)

DEPTH = 6
LEAST_COUNT = 16
LEAST_DIVERGENCE = 0.01
SMOOTHING = 2.0
HOT_SHARE = 1e-5
HOT_GRAMS = 1 << 21  # broadcast at most; all other grams are joined
BLOCK = 1 << 17
HELD_GRAMS = 1 << 20
BUCKET_BITS = 9  # of words and of grams; a task of the counting holds the distinct keys of one bucket
WORD, LEARNT, OTHER, ALL = 0, 1, 2, 3
DEALT = "bucket int, kind int, keys binary, counts binary"
COUNTS = "kind int, key long, n long"
SPACE, END = 32, 10
END_TOKEN = b"\n"  # no word holds white space, so the end token cannot be one


def stream(words: list[bytes]) -> np.ndarray:
    """The symbols of a text after `DEPTH` end symbols, which stand for its start."""
    body = b" ".join(words) + b" \n" if words else b"\n"
    return np.frombuffer(b"\n" * DEPTH + body, np.uint8)


_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_FOLDED[9:14] = SPACE


def streams_of(texts: list[bytes]) -> list[np.ndarray]:
    """The `stream` of each text, as parts of one array."""
    if not texts:
        return []
    start = b"\n" * DEPTH
    symbols = _FOLDED[np.frombuffer(b"".join(part for text in texts for part in (start, text, b" \n")), np.uint8)]
    stops = np.cumsum([DEPTH + len(text) + 2 for text in texts])
    ends = np.concatenate([[0], stops[:-1]])[:, None] + np.arange(DEPTH)
    symbols[ends] = symbols[stops - 1] = END
    # White space stays behind a word only, once; no other symbol is an end.
    kept = symbols != SPACE
    kept[1:] |= (symbols[:-1] != SPACE) & (symbols[:-1] != END)
    return np.split(symbols[kept], np.cumsum(kept)[stops[:-1] - 1])


def _grams(symbols: np.ndarray) -> np.ndarray:
    """DEPTH context bytes and the symbol that follows, as one integer for each symbol."""
    count = len(symbols) - DEPTH
    packed = np.zeros(count, np.int64)
    for place in range(DEPTH + 1):
        packed = (packed << 8) | symbols[place : place + count]
    return packed


def _merged(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums by distinct key, keys in order."""
    key, n = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n[order], first)


def _dealt(kind: int, keys: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """A row of compressed steps for each bucket. Grams of one context share a bucket, so that steps
    are small; they are 256 at most."""
    mixed = mix((keys if kind == WORD else keys >> 8).view(np.uint64))
    bucket = (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16) * 2 + (kind != WORD)
    filled, parts = by_bucket(bucket)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(filled.astype(np.int32)), pa.array(np.full(len(filled), kind, np.int32)),
            pa.array([squeezed_steps(keys[part]) for part in parts], pa.binary()),
            pa.array([squeezed(times[part], "<i8") for part in parts], pa.binary()),
        ],
        ["bucket", "kind", "keys", "counts"],
    )


def _counted(batches) -> Iterator[pa.RecordBatch]:
    """Counts of words and grams of a few slices of texts; of texts not learnt from only grams."""
    held: dict[int, tuple[list, list]] = {kind: ([], []) for kind in (WORD, LEARNT, OTHER)}

    def hold(kind: int, keys: np.ndarray, times: np.ndarray) -> None:
        held[kind][0].append(keys)
        held[kind][1].append(times)

    for batch in sliced(batches, "text"):
        learnt = np.array(batch.column("learnt").to_pylist())
        for kind, mask in ((LEARNT, learnt), (OTHER, ~learnt)):
            texts = blobs(batch.column("text").filter(pa.array(mask)))
            if not texts:
                continue
            if kind == LEARNT:
                codes, _, distinct = coded_words(texts)
                times = np.append(np.bincount(codes, minlength=len(distinct)), len(texts))
                keys = WordHashes.of([*distinct, END_TOKEN]).view(np.int64)
                # The empty word is none, if it is there.
                hold(WORD, *_merged([keys[times > 0]], [times[times > 0]]))
                del codes, distinct, times, keys
            streams = streams_of(texts)
            del texts
            # Filled and sorted in place: one array of the slice's size at a time.
            grams = np.empty(sum(len(one) - DEPTH for one in streams), np.int64)
            at = 0
            for one in streams:
                grams[at : at + len(one) - DEPTH] = _grams(one)
                at += len(one) - DEPTH
            grams.sort()
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            hold(kind, grams[first], np.diff(first, append=len(grams)))
            del grams, first, streams
        for kind, (keys, times) in held.items():
            if sum(map(len, keys)) > HELD_GRAMS:
                yield _dealt(kind, *_merged(keys, times))
                held[kind] = ([], [])
    for kind, (keys, times) in held.items():
        if keys:
            yield _dealt(kind, *_merged(keys, times))


def _summed(dealt: pa.Table) -> pa.Table:
    """One bucket: sums by key of words and of grams learnt from, and of grams of all texts."""
    sums: dict[int, tuple[list, list]] = {}
    limit = HELD_GRAMS
    for kind, keys, counts in zip(*(dealt[c].to_pylist() for c in ("kind", "keys", "counts"))):
        for name in (WORD,) if kind == WORD else (LEARNT, ALL) if kind == LEARNT else (ALL,):
            some = sums.setdefault(name, ([], []))
            some[0].append(restored_steps(keys))
            some[1].append(restored(counts, "<i8"))
            if sum(map(len, some[0])) > limit:
                key, n = _merged(*some)
                sums[name] = ([key], [n])
                limit = max(limit, 2 * len(key))
    found = [(name, *_merged(*some)) for name, some in sums.items()]
    return pa.table(
        {
            "kind": np.concatenate([np.full(len(key), name, np.int32) for name, key, _ in found]),
            "key": np.concatenate([key for _, key, _ in found]),
            "n": np.concatenate([n for _, _, n in found]),
        }
    )


class SuffixTree:
    """The model in memory, for small corpora: states as rows of log10 probabilities; `child` steps
    to the context one byte longer."""

    def __init__(self, root: np.ndarray):
        self.log = [np.log10((root + 1) / (root.sum() + 256))]
        self.child = [np.zeros(256, np.int32)]
        self.known: dict[bytes, int] = {b"": 0}

    def state(self, context: bytes) -> int:
        """The state of the longest kept suffix."""
        while context not in self.known:
            context = context[1:]
        return self.known[context]

    def _append(self, context: bytes, log: np.ndarray) -> None:
        if context[1:] not in self.known:  # a step on the way that predicts as its suffix does
            self._append(context[1:], self.log[self.state(context[1:])])
        self.child[self.known[context[1:]]][context[0]] = self.known[context] = len(self.log)
        self.log.append(log)
        self.child.append(np.zeros(256, np.int32))

    def add(self, context: bytes, counts: np.ndarray) -> None:
        """Keep the context if it diverges from its longest kept suffix; they come by rising length."""
        expected, total = 10.0 ** self.log[self.state(context[1:])], counts.sum()
        seen = counts > 0
        share = counts[seen] / total
        if (share * np.log(share / expected[seen])).sum() >= LEAST_DIVERGENCE:
            self._append(context, np.log10((counts + SMOOTHING * expected) / (total + SMOOTHING)))

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.log, np.float32), np.array(self.child)


def _suffix(context: str, depth: int):
    return F.col(context).bitwiseAND(F.lit((1 << (8 * depth)) - 1))


def learn(grams: DataFrame, ws: Workspace) -> list[DataFrame]:
    """context, back, next of each depth from 0: the contexts that occur often enough.

    `next` holds the probability of each symbol seen there, from the context itself if it is kept
    and from its longest kept suffix if not; `back` is the factor of the suffix's probability for
    the other symbols, 1 if the context is not kept. A suffix occurs as often as its context at
    least and is followed by the same symbols, so joins by suffix find all they need.
    """
    entries = grams.select(
        F.shiftright("key", 8).alias("context"), F.col("key").bitwiseAND(F.lit(255)).cast("int").alias("symbol"), "n"
    )
    counted: list[DataFrame] = []
    for depth in range(DEPTH, -1, -1):
        if depth < DEPTH:
            entries = ws.land(
                entries.groupBy(_suffix("context", depth).alias("context"), "symbol").agg(F.sum("n").alias("n")),
                f"entries-{depth}",
            )
        counted.append(
            entries.groupBy("context")  # at most 256 symbols each
            .agg(F.sum("n").alias("total"), F.collect_list(F.struct("symbol", "n")).alias("seen"))
        )
    counted.reverse()
    zero = F.lit(0).cast("long")
    total = F.coalesce(F.max("total"), zero)
    seen = F.coalesce(F.first("seen"), F.array().cast("array<struct<symbol:int,n:bigint>>"))
    n = F.coalesce(F.element_at(F.map_from_entries("seen"), F.col("symbol")), zero)
    root = (
        counted[0].agg(total.alias("total"), seen.alias("seen"))
        .withColumn("symbol", F.explode(F.sequence(F.lit(0), F.lit(255))))
        .groupBy(F.lit(0).cast("long").alias("context"))
        .agg(F.collect_list(F.struct("symbol", ((n + 1) / (F.col("total") + 256)).alias("p"))).alias("next"))
    )
    tables = [ws.land(root.select("context", F.lit(1.0).alias("back"), "next"), "depth-0")]
    for depth in range(1, DEPTH + 1):
        suffixes = tables[-1].select(
            F.col("context").alias("suffix"), F.map_from_entries("next").alias("expected")
        )
        if depth <= 2:
            suffixes = F.broadcast(suffixes)  # 256 rows at most
        rows = (
            counted[depth].where(F.col("total") >= LEAST_COUNT)
            .withColumn("suffix", _suffix("context", depth - 1))
            .join(suffixes, "suffix")
        )
        both = F.transform(
            "seen",
            lambda s: F.struct(
                s["symbol"].alias("symbol"), s["n"].alias("n"), F.element_at("expected", s["symbol"]).alias("q")
            ),
        )
        divergence = F.aggregate(
            "both",
            F.lit(0.0),
            lambda a, s: a + s["n"] / F.col("total") * F.log(s["n"] / F.col("total") / s["q"]),
        )
        whole = F.col("total") + SMOOTHING
        own = F.transform(
            "both",
            lambda s: F.struct(
                s["symbol"].alias("symbol"),
                F.when(F.col("kept"), (s["n"] + SMOOTHING * s["q"]) / whole).otherwise(s["q"]).alias("p"),
            ),
        )
        tables.append(
            ws.land(
                rows.select("context", "total", both.alias("both"))
                .withColumn("kept", divergence >= LEAST_DIVERGENCE)
                .select("context", F.when(F.col("kept"), SMOOTHING / whole).otherwise(1.0).alias("back"), own.alias("next")),
                f"depth-{depth}",
            )
        )
    return tables


def gram_scores(grams: DataFrame, tables: list[DataFrame], ws: Workspace) -> DataFrame:
    """key, n, score: log10 probability of each gram's symbol after its context.

    From the longest contexts on; a gram leaves at the first one that its symbol was seen after.
    """
    left = grams.select("key", "n", F.lit(0.0).alias("score"))
    done: list[DataFrame] = []
    for depth in range(DEPTH, -1, -1):
        states = tables[depth].select("context", "back", F.map_from_entries("next").alias("next"))
        if depth <= 1:
            states = F.broadcast(states)  # 256 rows at most
        symbol = F.col("key").bitwiseAND(F.lit(255)).cast("int")
        looked = ws.land(
            left.withColumn("context", F.shiftright("key", 8).bitwiseAND(F.lit((1 << (8 * depth)) - 1)))
            .join(states, "context", "left")
            .select(
                "key", "n", "score", F.log10(F.coalesce("back", F.lit(1.0))).alias("back"),
                F.log10(F.element_at("next", symbol)).alias("p"),
            ),
            f"looked-{depth}",
        )
        done.append(looked.where("p IS NOT NULL").select("key", "n", (F.col("score") + F.col("p")).alias("score")))
        left = looked.where("p IS NULL").select("key", "n", (F.col("score") + F.col("back")).alias("score"))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


class HotGrams:
    """Scores of frequent grams by hashing with `PROBES` tries; what finds no slot is not hot."""

    PROBES = 4

    def __init__(self, keys: np.ndarray, scores: np.ndarray):
        self.bits = max(4, (len(keys) * 3 // 2).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)  # no gram is negative
        self.scores = np.zeros(1 << self.bits)
        for probe in range(self.PROBES):
            slot = self.slots(keys, probe)
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.scores[slot[placed]] = scores[placed]
            keys, scores = keys[~placed], scores[~placed]

    def slots(self, keys: np.ndarray, probe: int) -> np.ndarray:
        salt = np.array([probe + 1], np.uint64) * GOLDEN
        mixed = mix(keys.view(np.uint64) + salt)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.intp)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores, 0 where a gram is not hot, and the places of those."""
        scores = np.zeros(len(keys))
        rest, missing = np.arange(len(keys)), []
        for probe in range(self.PROBES):
            wanted = keys[rest]
            slot = self.slots(wanted, probe)
            there = self.keys.take(slot)
            hit, free = there == wanted, there == -1  # a slot left free: no later try found one
            scores[rest[hit]] = self.scores.take(slot[hit])
            missing.append(rest[free])
            rest = rest[~(hit | free)]
            if not len(rest):
                break
        return scores, np.sort(np.concatenate([*missing, rest]))


def _blocks(streams: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams of all texts and the place of each one's text, some `BLOCK` symbols at a time."""
    some, owners, size = [], [], 0
    for i, symbols in enumerate(streams):
        for start in range(0, len(symbols) - DEPTH, BLOCK):
            part = symbols[start : start + BLOCK + DEPTH]
            some.append(part)
            owners.append(i)
            size += len(part)
            if size >= BLOCK:
                yield _joined(some, owners)
                some, owners, size = [], [], 0
    if some:
        yield _joined(some, owners)


def _joined(parts: list[np.ndarray], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(owners, [len(part) for part in parts])
    # A gram belongs to the part of its symbol, and starts there too.
    inside = owner[DEPTH:] == owner[:-DEPTH]
    return _grams(np.concatenate(parts))[inside], owner[DEPTH:][inside]


def _lists(lengths: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), values)


def text_scores(texts: list[bytes], hot: HotGrams) -> tuple[np.ndarray, pa.ListArray, pa.ListArray]:
    """Of each text the sum over hot grams, the other grams, and their counts."""
    totals = np.zeros(len(texts))
    others: list[list[np.ndarray]] = [[] for _ in texts]
    for grams, owner in _blocks(streams_of(texts)):
        scores, rest = hot.look_up(grams)
        first = int(owner[0])
        sums = np.bincount(owner - first, weights=scores)
        totals[first : first + len(sums)] += sums
        places, starts = np.unique(owner[rest], return_index=True)
        for i, part in zip(places.tolist(), np.split(grams[rest], starts[1:])):
            others[i].append(part)
    none = [np.zeros(0, np.int64)]
    counted = [np.unique(np.concatenate(some or none), return_counts=True) for some in others]
    lengths = [len(grams) for grams, _ in counted]
    grams, times = (np.concatenate(some or none) for some in ([c[0] for c in counted], [c[1] for c in counted]))
    return totals, _lists(lengths, grams), _lists(lengths, times.astype(np.int32))


def text_words(texts: list[bytes], frequent: dict[int, float]) -> tuple[np.ndarray, ...]:
    """Of each text the number of tokens, of those that are frequent words and the sum of their parts,
    the other words, and their counts."""
    count = len(texts)
    codes, words, distinct = coded_words(texts)
    keys = WordHashes.of([*distinct, END_TOKEN]).view(np.int64)
    codes = np.concatenate([codes, np.full(count, len(distinct))])
    owner = np.concatenate([np.repeat(np.arange(count), words), np.arange(count)])
    part = np.array([frequent.get(key, np.nan) for key in keys.tolist()])[codes]
    rare = np.isnan(part)
    known = np.bincount(owner[~rare], minlength=count)
    base = np.bincount(owner[~rare], weights=part[~rare], minlength=count)
    pairs, times = np.unique(owner[rare] * len(keys) + codes[rare], return_counts=True)
    lengths = np.bincount(pairs // len(keys), minlength=count)
    return words + 1, known, base, _lists(lengths, keys[pairs % len(keys)]), _lists(lengths, times.astype(np.int32))


def score_texts(docs: DataFrame, modulus: int = 7, remainder: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Rows of the held-out fold and null ids are not learnt from. A null text is empty: one end
    token. Rows repeating a doc_id are scored apart. Without training texts the base gives every
    token 1 / 1 and the tree a uniform distribution.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "lm")
    held_out = in_fold("doc_id", modulus, remainder)
    texts = id_text(docs)
    counts = ws.land(
        texts.select((~held_out).alias("learnt"), "text")
        .mapInArrow(_counted, DEALT)
        .groupBy("bucket")
        .applyInArrow(_summed, COUNTS),
        "counts",
    )
    words = counts.where(F.col("kind") == WORD).select("key", "n")
    size = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = size["n"] or 0, size["v"]
    hot = {  # at most 1 / HOT_SHARE words
        row["key"]: float(np.log10(row["n"] + 1))
        for row in words.where(F.col("n") >= max(1.0, HOT_SHARE * total)).collect()
    }
    tables = learn(counts.where(F.col("kind") == LEARNT).select("key", "n"), ws)
    grams = counts.where(F.col("kind") == ALL).select("key", "n")
    scores = ws.land(gram_scores(grams, tables, ws), "scores")
    ws.drop(*(f"{name}-{depth}" for depth in range(DEPTH + 1) for name in ("entries", "depth", "looked")))
    magnitude = F.floor(F.log2("n")).cast("int").alias("magnitude")
    often, least = 0, 64
    for row in scores.groupBy(magnitude).count().orderBy(F.desc("magnitude")).collect():
        often += row["count"]
        if often > HOT_GRAMS:
            break
        least = row["magnitude"]
    known = scores.where(magnitude >= least).select("key", "score").toArrow()
    hot_grams = HotGrams(*(known[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("key", "score")))
    model = spark.sparkContext.broadcast((hot, hot_grams))

    def scored(batches) -> Iterator[pa.RecordBatch]:
        """A row for each text with its rarer words, which are looked up by joining."""
        frequent, hot_grams = model.value
        for batch in sliced(batches, "text"):
            texts = blobs(batch.column("text"))
            tokens, known, base, *rare = text_words(texts, frequent)
            score, *others = text_scores(texts, hot_grams)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, (tokens, known, base, score)), *rare, *others],
                ["doc_id", "n_tokens", "known", "base", "score", "rare", "times", "grams", "gram_times"],
            )

    rows = ws.land(
        texts.mapInArrow(
            scored,
            "doc_id long, n_tokens long, known long, base double, score double, rare array<long>, times array<int>, "
            "grams array<long>, gram_times array<int>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "rows",
    )
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(
        "row", F.col("w.rare").alias("key"), F.col("w.times").alias("times")
    )
    looked_up = (
        rare.join(words, "key")
        .groupBy("row")
        .agg(
            F.sum("times").alias("more"),
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_base"),
        )
    )
    others = rows.select("row", F.explode(F.arrays_zip("grams", "gram_times")).alias("g")).select(
        "row", F.col("g.grams").alias("key"), F.col("g.gram_times").alias("times")
    )
    # A hot gram that found no slot is looked up here too.
    more_score = (
        others.join(scores.select("key", F.col("score").alias("each")), "key")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("each")).alias("more_score"))
    )
    whole = float(np.log10(total + distinct + 1))
    return rows.join(looked_up, "row", "left").join(more_score, "row", "left").select(
        "doc_id",
        in_fold("doc_id", modulus, remainder).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
