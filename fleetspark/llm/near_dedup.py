"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct shingles of `WIDTH` words. Every shingle draws exponentially
spaced values in rising order and offers them to registers in an order of its own; a register
keeps the smallest, stored as a truncated power of the base. Equal sets give equal registers, the
registers of a union are the element-wise maxima, and registers of similar sets often agree, so
bands of them serve as join keys.

Documents with equal sets form a class and are compared once. In every band bucket one class is
the centre, and the others are estimated against it (maximum likelihood over the registers),
then verified on full sets. Buckets whose classes are still in several components are compared in
blocks, so that links between members that miss the centre are found; a task emits at most a
spanning forest of verified links. No step sends a group to one task or emits all its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import (
    GOLDEN,
    WordHashes,
    Workspace,
    blobs,
    coded_words,
    id_text,
    mix,
    sliced,
)

WIDTH = 5
REGISTERS = 128
BAND_ROWS = 4
BANDS = REGISTERS // BAND_ROWS
BASE, RATE, LARGEST = 1.001, 20.0, (1 << 16) - 1
MARGIN = 0.2
BLOCK, BLOCK_SHINGLES = 2048, 1 << 21  # classes and shingles of a chunk
FILTER_BITS = 1 << 23
# Rows that go are told by a broadcast up to this many, by a join of whole rows beyond.
MOST_BROADCAST = 1_000_000

_ODD = mix(np.arange(1, WIDTH + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
# Texts sketched at once: a shingle takes some hundred bytes meanwhile.
SKETCHED_BYTES = 1 << 20


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; a short text is one shingle."""
    codes, counts, distinct = coded_words(texts)
    flat = WordHashes.of(distinct)[codes]
    # A window's hash covers its words in order; windows across two texts are never read.
    windows = np.zeros(max(0, len(flat) - WIDTH + 1), np.uint64)
    for place in range(WIDTH):
        windows += mix(flat[place : place + len(windows)] + _ODD[place]) * _ODD[place]
    windows = mix(windows)
    sets, start = [], 0
    for count in counts.tolist():
        if count >= WIDTH:
            sets.append(np.unique(windows[start : start + count - WIDTH + 1]))
        elif count:
            short = np.array([count], np.uint64) * GOLDEN
            for place in range(count):
                short = mix(short + mix(flat[start + place : start + place + 1] + _ODD[place]))
            sets.append(short)
        else:
            sets.append(np.zeros(0, np.uint64))
        start += count
    return sets


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of non-empty sets, one row each.

    Elements leave as soon as their next value cannot lower any register of their set.
    """
    count = len(sets)
    low = np.full(count * REGISTERS, np.inf)
    owner = np.repeat(np.arange(count), [len(s) for s in sets])
    element = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    mask = np.uint64(REGISTERS - 1)
    first = mix(element ^ np.uint64(0x5851F42D4C957F2D))
    start, step = first & mask, (first >> np.uint64(20)) | np.uint64(1)
    value = np.zeros(len(element))
    draws = np.arange(1, REGISTERS + 1, dtype=np.uint64) * GOLDEN
    for turn in range(REGISTERS):
        uniform = (mix(element + draws[turn]) >> np.uint64(11)) * 2.0**-53
        value = value - np.log1p(-uniform) / (RATE * (REGISTERS - turn))
        register = ((start + np.uint64(turn) * step) & mask).astype(np.int64)
        np.minimum.at(low, owner * REGISTERS + register, value)
        worst = low.reshape(count, REGISTERS).max(axis=1) if count else low
        alive = value < worst[owner]
        if not alive.any():
            break
        owner, element, value = owner[alive], element[alive], value[alive]
        start, step = start[alive], step[alive]
    power = np.floor(1.0 - np.log(np.maximum(low, 1e-300)) / np.log(BASE))
    return np.clip(power, 0, LARGEST).astype(np.uint16).reshape(count, REGISTERS)


def joint_estimate(a: np.ndarray, b: np.ndarray, sizes_a, sizes_b) -> np.ndarray:
    """Maximum-likelihood similarity from how many registers are larger, smaller and equal.

    `a` and `b` hold registers row by row; set sizes are known exactly.
    """
    greater = (a > b).sum(axis=-1).astype(float)
    less = (a < b).sum(axis=-1).astype(float)
    return likely_similarity(greater, less, REGISTERS - greater - less, sizes_a, sizes_b)


def likely_similarity(greater, less, equal, sizes_a, sizes_b) -> np.ndarray:
    total = np.asarray(sizes_a, float) + sizes_b
    u, v = sizes_a / total, sizes_b / total
    low, high = np.zeros_like(total), np.minimum(u / v, v / u)

    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        up, down = chance(u - v * j), chance(v - u * j)
        tiny = 1e-12
        return (
            greater * np.log(np.maximum(up, tiny))
            + less * np.log(np.maximum(down, tiny))
            + equal * np.log(np.maximum(1 - up - down, tiny))
        )

    for _ in range(24):  # the likelihood is concave in the similarity
        third = (high - low) / 3
        right = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(right, low + third, low), np.where(right, high, high - third)
    return (low + high) / 2


def alike(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether den * intersection >= num * union, on full sorted sets."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return den * common >= num * (len(a) + len(b) - common)


def _class(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _sketched(batches) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text", SKETCHED_BYTES):
        sets = shingle_sets(blobs(batch.column("text")))
        filled = [i for i, s in enumerate(sets) if len(s)]
        registers = iter(sketch([sets[i] for i in filled]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_class(s) for s in sets], pa.binary()),
                pa.array([next(registers).tobytes() if len(s) else None for s in sets], pa.binary()),
            ],
            ["doc_id", "text_key", "n_shingles", "class", "registers"],
        )


def _banded(batches) -> Iterator[pa.RecordBatch]:
    salt = np.arange(1, BANDS + 1, dtype=np.uint64) * GOLDEN
    for batch in batches:
        rows = batch.num_rows
        if rows:
            raw = b"".join(batch.column("registers").to_pylist())
            keys = mix(np.frombuffer(raw, np.uint64).reshape(rows, BANDS) + salt)
            places = pa.array(np.repeat(np.arange(rows), BANDS))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.reshape(-1).view(np.int64)),
                    batch.column("class").take(places),
                    batch.column("n_shingles").take(places),
                ],
                ["key", "class", "n"],
            )


def _estimated(least: float):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                for c in ("registers_a", "registers_b")
            )
            sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
            likely = joint_estimate(a, b, *sizes) >= least
            yield batch.select(["a", "b"]).filter(pa.array(likely))

    return run


def _verified(num: int, den: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            true = [
                alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), num, den)
                for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())
            ]
            yield batch.select(["a", "b"]).filter(pa.array(true, pa.bool_()))

    return run


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """class, registers, shingles of the wanted classes, from the texts of their first documents.

    A bitmap of fixed size leaves out most other texts before anything moves.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    parts = (
        wanted.select(F.col("first_id").alias("doc_id"))
        .select(slot.alias("slot"))
        .groupBy(F.expr("slot div 32768").alias("part"))
        .agg(F.expr("bitmap_construct_agg(slot % 32768)").alias("bits"))
        .collect()  # at most FILTER_BITS / 32768 rows of 4 KiB
    )
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for part in parts:
        start = part["part"] * 4096
        bits[start : start + 4096] = np.frombuffer(bytes(part["bits"]), np.uint8)

    def again(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = batch.column("slot").to_numpy()
            there = (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1
            for part in sliced([batch.filter(pa.array(there.astype(bool)))], "text", SKETCHED_BYTES):
                sets = shingle_sets(blobs(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_class(s) for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["class", "shingles"],
                )

    return (
        id_text(docs)
        .withColumn("slot", slot)
        .mapInArrow(again, "class binary, shingles binary")
        .join(wanted.select("class", "registers"), "class")
        .dropDuplicates(["class"])
    )


def _block_links(num: int, den: int):
    """Verified links of one block of a bucket: a spanning forest over its components."""

    def run(group: pa.Table) -> pa.Table:
        classes, comps = group["class"].to_pylist(), group["comp"].to_pylist()
        sizes = group["n"].to_numpy()
        side = group["chunk"].to_numpy()
        registers = np.frombuffer(b"".join(group["registers"].to_pylist()), np.uint16)
        registers = registers.reshape(-1, REGISTERS)
        one_chunk = group["low"][0].as_py() == group["high"][0].as_py()
        number = {c: i for i, c in enumerate(dict.fromkeys(comps))}
        comp = np.array([number[c] for c in comps])
        firsts, seconds, equals = [], [], []
        for i in range(len(classes) - 1):
            later = slice(i + 1, None)
            fits = (comp[later] != comp[i]) & (one_chunk | (side[later] != side[i]))
            fits &= den * np.minimum(sizes[later], sizes[i]) >= num * np.maximum(sizes[later], sizes[i])
            others = np.flatnonzero(fits) + i + 1
            likely = joint_estimate(
                registers[others], registers[i], sizes[others], np.full(len(others), sizes[i])
            )
            others, likely = others[likely >= num / den - MARGIN], likely[likely >= num / den - MARGIN]
            firsts.append(np.full(len(others), i))
            seconds.append(others)
            equals.append(likely)
        links: list[tuple[bytes, bytes]] = []
        if firsts:
            first, second = np.concatenate(firsts), np.concatenate(seconds)
            order = np.argsort(-np.concatenate(equals), kind="stable")
            sets = group["shingles"]
            parent = list(range(len(number)))

            def root(x: int) -> int:
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for place in order:
                i, j = int(first[place]), int(second[place])
                a, b = root(int(comp[i])), root(int(comp[j]))
                if a != b and alike(
                    *(np.frombuffer(sets[k].as_buffer(), np.uint64) for k in (i, j)), num, den
                ):
                    parent[a] = b
                    links.append((classes[i], classes[j]))
        return pa.table(
            {
                "a": pa.array([x for x, _ in links], pa.binary()),
                "b": pa.array([y for _, y in links], pa.binary()),
            }
        )

    return run


def components(edges: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """node, root of every node of an undirected graph with columns a and b.

    Each round sends every node to the smallest of its neighbours and itself, and keeps the edges
    that still join different nodes; node ids are hashes, so rounds grow with the logarithm of
    the longest chain. All steps are joins and aggregates of two-column tables.
    """
    mapping, turn = None, 0
    edges = edges.where("a <> b")
    while True:
        ends = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        step = ws.land(
            ends.groupBy("a").agg(F.min("b").alias("b")).select(
                F.col("a").alias("node"), F.least("a", "b").alias("to")
            ),
            f"{name}-step-{turn}",
        )
        if mapping is None:
            joined = step.withColumnRenamed("to", "root")
        else:
            joined = mapping.join(
                step.withColumnRenamed("node", "root"), "root", "left"
            ).select("node", F.coalesce("to", "root").alias("root"))
        mapping = ws.land(joined, f"{name}-map-{turn}")
        edges = ws.land(
            edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b")
            .where("to_a <> to_b")
            .select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
            .distinct(),
            f"{name}-edges-{turn}",
        )
        if edges.isEmpty():
            return mapping
        turn += 1


def near_duplicates(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles, class, component_id, kept.

    Rows link when den * intersection >= num * union of their shingle sets; component_id is the
    smallest doc_id reachable, kept whether it is the row's own. Null and wordless texts have the
    empty set, link with nothing, not even each other, and are kept. Rows repeating a doc_id are
    separate nodes; of equal rows each carries the same ids. A null doc_id is never the smallest
    unless a component has no other. Rows of equal ids are told apart by `drop_near_duplicates` only.
    """
    return _grouped(docs, num, den).drop("text_key", "root")


def _grouped(docs: DataFrame, num: int, den: int) -> DataFrame:
    """The columns of `near_duplicates`, the text's hash, and one class of the row's component."""
    spark = docs.sparkSession
    ws = Workspace(spark, "near-dedup")
    least = num / den - MARGIN
    sketched = ws.land(
        id_text(docs).withColumn("text_key", F.xxhash64("text")).mapInArrow(
            _sketched,
            "doc_id long, text_key long, n_shingles long, class binary, registers binary",
        ),
        "sketched",
    )
    classes = ws.land(
        sketched.where("class IS NOT NULL")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.first("n_shingles").alias("n"),
            F.first("registers").alias("registers"),
        ),
        "classes",
    )
    bands = classes.select("registers", "class", F.col("n").alias("n_shingles")).mapInArrow(
        _banded, "key long, class binary, n long"
    )
    crowded = bands.groupBy("key").count().where("count > 1").select("key")
    members = ws.land(bands.join(crowded, "key"), "members")
    centres = (
        members.groupBy("key")
        .agg(F.min(F.struct(F.xxhash64("key", "class").alias("h"), "class", "n")).alias("centre"))
        .select("key", F.col("centre.class").alias("centre"), F.col("centre.n").alias("centre_n"))
    )
    first = F.col("class") < F.col("centre")
    stars = (
        members.join(centres, "key")
        .where(F.col("class") != F.col("centre"))
        .where(F.least("n", "centre_n") * den >= F.greatest("n", "centre_n") * num)
        .select(
            F.when(first, F.col("class")).otherwise(F.col("centre")).alias("a"),
            F.when(first, F.col("centre")).otherwise(F.col("class")).alias("b"),
        )
        .distinct()
    )
    facts = classes.select("class", "n", "registers")
    likely = ws.land(
        stars.join(facts.toDF("a", "n_a", "registers_a"), "a")
        .join(facts.toDF("b", "n_b", "registers_b"), "b")
        .mapInArrow(_estimated(least), "a binary, b binary"),
        "likely",
    )
    wanted = classes.select("class", "first_id", "registers").join(members.select("class"), "class", "left_semi")
    sets = ws.land(_sets(docs, wanted), "sets")
    edges = ws.land(
        likely.join(sets.select("class", "shingles").toDF("a", "set_a"), "a")
        .join(sets.select("class", "shingles").toDF("b", "set_b"), "b")
        .mapInArrow(_verified(num, den), "a binary, b binary"),
        "edges",
    )
    roots = components(edges, ws, "first")
    found = ws.land(_unresolved(members, roots, sets, num, den), "found")
    if not found.isEmpty():
        roots = components(edges.union(found), ws, "second")
    rooted = (
        classes.select("class", "first_id")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .select("class", "first_id", F.coalesce("root", "class").alias("root"))
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    component = rooted.join(smallest, "root").select("class", "component_id", "root")
    own = F.coalesce("component_id", "doc_id")
    result = ws.land(
        sketched.select("doc_id", "text_key", "n_shingles", "class")
        .join(component, "class", "left")
        .select(
            "doc_id", "text_key", "n_shingles", "class", own.alias("component_id"), "root",
            F.col("doc_id").eqNullSafe(own).alias("kept"),
        ),
        "result",
    )
    ws.drop("sketched", "classes", "members", "likely", "sets", "edges", "found")
    return result


def _unresolved(members, roots, sets, num: int, den: int) -> DataFrame:
    """Links within buckets whose classes are in several components so far."""
    placed = members.join(roots.withColumnRenamed("node", "class"), "class", "left").select(
        "key", "class", "n", F.coalesce("root", "class").alias("comp")
    )
    mark = F.xxhash64("comp")
    chunks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("shingles") / BLOCK_SHINGLES))
    open_keys = (
        placed.groupBy("key")
        .agg(
            F.min(mark).alias("low"),
            F.max(mark).alias("high"),
            F.bit_xor(F.xxhash64("class")).alias("content"),
            F.count("*").alias("size"),
            F.sum("n").alias("shingles"),
        )
        .where("low <> high")
        .groupBy("content", "size", "shingles")  # buckets of the same classes are compared once
        .agg(F.min("key").alias("key"))
        .select("key", chunks.cast("int").alias("chunks"))
    )
    chunk = F.pmod(F.xxhash64("class", "key"), F.col("chunks")).cast("int")
    dealt = (
        placed.join(open_keys, "key")
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("low", F.least("chunk", "other"))
        .withColumn("high", F.greatest("chunk", "other"))
        .drop("other", "chunks")
    )
    return (
        dealt.join(sets, "class")
        .groupBy("key", "low", "high")
        .applyInArrow(_block_links(num, den), "a binary, b binary")
    )


def drop_near_duplicates(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of `docs` that are kept: exactly one of each component, all columns as they are.

    The row of the smallest doc_id stays, null ids last; of rows of one id that with the smaller
    hash of its text, and of rows equal in both the first by their other columns. Rows without
    words link with nothing and all stay.
    """
    order = ("no_id", "doc_id", "text_key")
    ws = Workspace(docs.sparkSession, "near-dedup")
    rows = _grouped(docs, num, den).where("root IS NOT NULL").withColumn("no_id", F.isnull("doc_id"))
    keys = ws.land(rows.groupBy("root", *order).agg(F.count("*").alias("count")), "keys")
    chosen = keys.groupBy("root").agg(F.min(F.struct(*order)).alias("chosen"))
    stays = F.struct(*order) == F.col("chosen")
    # Keys that go, and those that stay but stand on several rows; all others need no mark.
    marks = ws.land(
        keys.join(chosen, "root")
        .withColumn("stays", stays)
        .where("NOT stays OR count > 1")
        .select(F.struct("doc_id", "text_key", "stays").alias("mark")),
        "marks",
    )
    if marks.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        marks = F.broadcast(marks)
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    doc_id = F.col("row.doc_id").cast("long")
    text_key = F.xxhash64(F.coalesce(F.col("row.text").cast("string"), F.lit("")))
    marked = rows.join(
        marks, doc_id.eqNullSafe(F.col("mark.doc_id")) & (text_key == F.col("mark.text_key")), "left"
    )
    others = [
        F.col(f"row.`{field.name}`")
        for field in docs.schema
        if field.name not in ("doc_id", "text") and "map<" not in field.dataType.simpleString()
    ]
    equal = Window.partitionBy(doc_id, text_key).orderBy(*others, text_key)
    repeated = marked.where("mark.stays").withColumn("place", F.row_number().over(equal)).where("place = 1")
    return marked.where("mark IS NULL").unionByName(repeated.drop("place")).select("row.*")
