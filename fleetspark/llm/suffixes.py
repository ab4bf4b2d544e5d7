"""Removal of repeated passages by suffix sorting, deep and shallow.

Every string of `length` bytes that starts at two places or more loses all its bytes, wherever it
stands; matches never cross documents. The suffixes to compare are found by anchors: in each
window of `length` bytes the gram of `GRAM` bytes with the smallest hash. Equal windows choose
equal anchors, so two equal windows are seen at one anchor, `before` bytes in. An anchor's context
holds every window that may contain it. Anchors whose gram is nowhere else are left out, equal
contexts are one class with a count, and what is left are groups of different contexts of one gram:

* their suffixes from the anchor on, and their reversed prefixes, are sorted by multikey
  quicksort, eight bytes a character and all groups of a block at once, to a shallow depth;
* groups that still share a long prefix go into a blind trie, which branches on bits alone and
  compares each suffix with one leaf; walking the trie yields order and common prefixes;
* windows `before` bytes into a context are equal where both sorted orders have common prefixes
  that reach far enough.

A group of more than `GROUP` contexts is split first on more of its bytes: windows with an anchor
early in them share more text after it, those with a late one more before it. Contexts of a half
that agree in all bytes its windows reach are one from there on: all these windows are repeated.
Halving goes on until groups fit or the range is one window. So no task ever holds a large group,
a context goes on only where its neighbours begin to differ, and nothing is dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import Workspace, blobs, id_text, sliced

LENGTH, GRAM, GROUP, BLOCK = 200, 64, 2_000, 30_000
SHALLOW = 4
P1, P2 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F)
OCCURRENCE = "gram long, context long, row long, n_bytes long, pos long"
CONTEXT = f"{OCCURRENCE}, n long, low int, high int, key long, around binary"
REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
SPAN = "row long, n_bytes long, start long, end long"


def _joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    z = x * P1
    z += y
    z ^= z >> np.uint64(32)
    z *= P2
    z ^= z >> np.uint64(29)
    return z


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the `GRAM` bytes from each position on; eight bytes, then twice as many."""
    h = np.ndarray(len(text) - 7, np.dtype("<u8"), text.data, strides=(1,)).astype(np.uint64)
    width = 8
    while width < GRAM:
        h = _joined(h[:-width], h[width:])
        width *= 2
    return h


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        keys = np.minimum(keys[:-reach], keys[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(keys[:-rest], keys[rest:]) if rest else keys


def anchors(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text number, position, gram hash, context hash) of all anchors of the texts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    gap = bytes(length)
    starts = length + np.concatenate([[0], np.cumsum(sizes + length)[:-1]])
    text = np.frombuffer(gap + b"".join(part for t in texts for part in (t, gap)), np.uint8)
    h = _gram_hashes(text)
    lowest = _sliding_min(
        (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64), length - GRAM + 1
    )
    edges = np.zeros(len(lowest) + 1, np.int8)
    whole = sizes >= length
    edges[starts[whole]] = 1
    ends = (starts + sizes - length + 1)[whole]
    edges[ends] -= 1
    at = (lowest[np.cumsum(edges[:-1], dtype=np.int8) > 0] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at = at[np.diff(at, prepend=-1) > 0]
    number = np.searchsorted(starts, at, "right") - 1
    before = length - GRAM
    known = np.minimum(at - starts[number], before)
    after = np.minimum(starts[number] + sizes[number] - at, length)
    context = (known * (length + 1) + after).astype(np.uint64)
    for step in [*range(-before, length - GRAM, GRAM), length - GRAM]:
        context = _joined(context, h[at + step])
    return number, at - starts[number], h[at].view(np.int64), context.view(np.int64)


def _find_anchors(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            row = batch.column("row").to_numpy()
            size = batch.column("n_bytes").to_numpy()
            number, pos, gram, context = anchors(blobs(batch.column("text")), length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (gram, context, row[number], size[number], pos)],
                ["gram", "context", "row", "n_bytes", "pos"],
            )

    return run


def _cut_contexts(length: int):
    """What surrounds each wanted anchor, zeros beyond the text's ends."""
    before = length - GRAM
    names = [part.split()[0] for part in CONTEXT.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            columns: dict[str, list] = {name: [] for name in names}
            texts, rest = blobs(batch.column("text")), batch.drop_columns(["text"]).to_pylist()
            for row, text in zip(rest, texts):
                text = bytes(before) + text + bytes(length)
                for wanted in row["wanted"]:
                    for name in ("gram", "context", "pos", "n"):
                        columns[name].append(wanted[name])
                    columns["row"].append(row["row"])
                    columns["n_bytes"].append(row["n_bytes"])
                    columns["low"].append(0)
                    columns["high"].append(before)
                    columns["key"].append(0)
                    columns["around"].append(text[wanted["pos"] : wanted["pos"] + before + length])
            if columns["n"]:
                types = [pa.int32() if n in ("low", "high") else pa.int64() for n in names[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[n], t) for n, t in zip(names, [*types, pa.binary()])], names
                )

    return run


def _halves(length: int):
    """Contexts of large groups again, for either half of their range of windows.

    `key` is what every window of the half has, `reach` all bytes of its windows, if there.
    """
    before = length - GRAM

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                middle = (row["low"] + row["high"]) // 2
                for low, high in ((row["low"], middle), (middle + 1, row["high"])):
                    if row["pos"] >= low and row["n_bytes"] - row["pos"] >= length - high:
                        shared = row["around"][before - low : before + length - high]
                        key = xxhash.xxh3_64_intdigest(shared, seed=low * 1000 + high) - (1 << 63)
                        reach = None
                        if row["pos"] >= high and row["n_bytes"] - row["pos"] >= length - low:
                            reach = xxhash.xxh3_64_intdigest(row["around"][before - high : before + length - low]) - (1 << 63)
                        rows.append({**row, "low": low, "high": high, "key": key, "reach": reach})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, batch.schema.append(pa.field("reach", pa.int64())))

    return run


def blind_trie(keys: list[int], bits: int) -> tuple[list[int], list[int]]:
    """The keys' ascending order, and the bytes that each shares with the one before it.

    Inner nodes hold a bit only: a new key goes down by its own bits, is compared with the leaf it
    meets, and is then put where the first differing bit belongs. Equal keys share a leaf.
    """
    root: list = [-1, [0]]
    for i in range(1, len(keys)):
        key, node = keys[i], root
        while node[0] >= 0:
            node = node[1 + (key >> node[0] & 1)]
        differing = key ^ keys[node[1][0]]
        if not differing:
            node[1].append(i)
            continue
        top, node = differing.bit_length() - 1, root
        while node[0] > top:
            node = node[1 + (key >> node[0] & 1)]
        old, leaf = node[:], [-1, [i]]
        node[:] = [top, old, leaf] if key >> top & 1 else [top, leaf, old]
    order, shared, stack, top = [], [], [root], bits
    while stack:
        node = stack.pop()
        if isinstance(node, int):
            top = node
        elif node[0] >= 0:
            stack += [node[2], node[0], node[1]]
        else:
            order += node[1]
            shared += [(bits - 1 - top) // 8] + [bits // 8] * (len(node[1]) - 1)
    return order, shared


def sorted_suffixes(suffixes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of bytes by group and bytes; bytes shared with the row before, -1 at a
    group's first.

    `suffixes` has a multiple of eight bytes a row. Multikey quicksort splits by a character of
    eight bytes at a time; from `SHALLOW` splits on, what is tied goes to blind tries.
    """
    n, width = suffixes.shape
    words = suffixes.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    segment = np.cumsum(np.diff(group[order], prepend=group[order[:1]]) != 0)
    shared = np.full(n, -1, np.int64)
    tied = np.arange(n)
    depth = splits = 0
    while len(tied) and depth < width // 8 and splits < SHALLOW:
        word = words[order[tied], depth]
        place = np.lexsort((word, segment[tied]))
        order[tied], word = order[tied[place]], word[place]
        same = segment[tied][1:] == segment[tied][:-1]
        differ = np.flatnonzero(same & (word[1:] != word[:-1]))
        if len(differ):
            splits += 1
        bits = (word[differ] ^ word[differ + 1]).astype(">u8").view(np.uint8).reshape(-1, 8)
        shared[tied[differ + 1]] = depth * 8 + np.argmax(bits != 0, axis=1)
        new = np.concatenate([[0], (~same) | (word[1:] != word[:-1])]).astype(np.int64)
        segment[tied] = np.cumsum(new)
        alone = np.ones(len(tied), bool)
        together = np.flatnonzero(new[1:] == 0)
        alone[together] = alone[together + 1] = False
        tied = tied[~alone]
        depth += 1
    if len(tied):
        rest = width - depth * 8
        tail = np.ascontiguousarray(suffixes[order[tied], depth * 8 :])
        keys = [int.from_bytes(row.tobytes(), "big") for row in tail]
        cuts = [0, *(np.flatnonzero(np.diff(segment[tied])) + 1).tolist(), len(tied)]
        for low, high in zip(cuts, cuts[1:]):
            inner, common = blind_trie(keys[low:high], rest * 8)
            places = tied[low:high]
            order[places] = order[places][inner]
            shared[places[1:]] = depth * 8 + np.array(common[1:], np.int64)
    return order, shared


def equal_windows(
    around: np.ndarray, group: np.ndarray, pos: np.ndarray, size: np.ndarray, low: np.ndarray, high: np.ndarray, length: int
) -> Iterator[tuple[int, np.ndarray]]:
    """(bytes before the anchor, contexts whose window there equals another's of the group)."""
    before = length - GRAM
    pad = -before % 8
    after_order, after = sorted_suffixes(np.ascontiguousarray(np.pad(around[:, before:], ((0, 0), (0, -length % 8)))), group)
    back_order, back = sorted_suffixes(
        np.ascontiguousarray(np.pad(around[:, :before][:, ::-1], ((0, 0), (0, pad)))), group
    )

    def longest(order: np.ndarray, shared: np.ndarray) -> np.ndarray:
        most = np.empty(len(order), np.int64)
        most[order] = np.maximum(shared, np.append(shared[1:], -1))
        return most

    far, near = longest(after_order, after), longest(back_order, back)
    near = np.minimum(near, before)
    for offset in range(max(0, length - int(far.max(initial=0))), int(near.max(initial=-1)) + 1):
        live = (
            (near >= offset) & (far >= length - offset) & (pos >= offset) & (size - pos >= length - offset)
            & (low <= offset) & (offset <= high)
        )
        if live.sum() < 2:
            continue
        one, two = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
        one[after_order] = np.cumsum(after < length - offset)
        two[back_order] = np.cumsum(back < offset)
        chosen = np.flatnonzero(live)
        both = one[chosen] * (len(group) + 1) + two[chosen]
        ranked = np.argsort(both, kind="stable")
        same = both[ranked][1:] == both[ranked][:-1]
        hit = np.zeros(len(chosen), bool)
        hit[ranked[1:][same]] = hit[ranked[:-1][same]] = True
        if hit.any():
            yield offset, chosen[hit]


def _sort_groups(length: int):
    """Spans of contexts that are alone in their class; groups arrive whole and in order."""

    def spans(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        width = 2 * length - GRAM
        around = np.frombuffer(b"".join(rows["around"].to_pylist()), np.uint8).reshape(-1, width)
        part = {name: rows[name].to_numpy() for name in ("gram", "key", "low", "high", "row", "n_bytes", "pos", "n")}
        new = np.zeros(len(around), bool)
        for name in ("gram", "key", "low", "high"):
            new[1:] |= part[name][1:] != part[name][:-1]
        found = list(equal_windows(around, np.cumsum(new), part["pos"], part["n_bytes"], part["low"], part["high"], length))
        if not found:
            return
        offset = np.concatenate([np.full(len(which), o) for o, which in found])
        which = np.concatenate([which for _, which in found])
        kept = part["n"][which] == 1
        offset, which = offset[kept], which[kept]
        ranked = np.lexsort((offset, which))
        offset, which = offset[ranked], which[ranked]
        first = np.flatnonzero((np.diff(which, prepend=-1) != 0) | (np.diff(offset, prepend=-9) != 1))
        if len(first):
            last = np.append(first[1:], len(which)) - 1
            w, pos = which[first], part["pos"][which[first]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (part["row"][w], part["n_bytes"][w], pos - offset[last], pos - offset[first] + length)],
                ["row", "n_bytes", "start", "end"],
            )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < BLOCK:
                continue
            rows = pa.Table.from_batches(held)
            last = np.zeros(rows.num_rows, bool)
            for name in ("gram", "key", "low", "high"):
                column = rows[name].to_numpy()
                last |= column != column[-1]
            whole = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            held = rows.slice(whole).to_batches()
            if whole:
                yield from spans(rows.slice(0, whole))
        if held:
            yield from spans(pa.Table.from_batches(held))

    return run


def _remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        kept, removed, runs = [], [], []
        for text, spans in zip(blobs(batch.column("text")), batch.column("spans").to_pylist()):
            pieces, end = [], 0
            for start, stop in sorted((s["start"], s["end"]) for s in spans or ()):
                pieces.append(text[end:start])
                end = stop
            pieces.append(text[end:])
            kept.append(b"".join(pieces))
            removed.append(len(text) - len(kept[-1]))
            runs.append(len(pieces) - 1)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def remove_repeats(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes) of every row.

    A null text is empty; texts below `length` bytes lose nothing. A row that repeats another's
    text loses all of a text of `length` bytes or more. A null id is an id like others. Other
    columns are ignored, an empty table gives an empty result. `length` is at least `GRAM` + 8.
    """
    ws = Workspace(docs.sparkSession, "repeats")
    texts = id_text(docs).select(
        "doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"), F.xxhash64("doc_id", "text").alias("row")
    )
    found = texts.where(F.col("n_bytes") >= length).select("row", "n_bytes", "text").mapInArrow(_find_anchors(length), OCCURRENCE)
    again = found.groupBy("gram").count().where("count > 1").select("gram")
    hits = ws.land(found.join(again.hint("merge"), "gram", "left_semi"), "hits")
    classes = ws.land(
        hits.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(F.struct("row", "n_bytes", "pos")).alias("one")),
        "classes",
    )
    copies = hits.join(classes.where("n > 1").select("gram", "context").hint("merge"), ["gram", "context"], "left_semi").select(
        "row", "n_bytes",
        F.greatest(F.lit(0).cast("long"), F.col("pos") - (length - GRAM)).alias("start"),
        F.least(F.col("n_bytes"), F.col("pos") + length).alias("end"),
    )
    ws.land(copies.distinct(), "span-copies")

    mixed = classes.groupBy("gram").count().where("count > 1").select("gram")
    wanted = (
        classes.join(mixed.hint("merge"), "gram", "left_semi")
        .groupBy(F.col("one.row").alias("row"), F.col("one.n_bytes").alias("n_bytes"))
        .agg(F.collect_list(F.struct("gram", "context", F.col("one.pos").alias("pos"), "n")).alias("wanted"))
    )
    same = Window.partitionBy("row", "n_bytes").orderBy("row")
    once = (
        texts.where(F.col("n_bytes") >= length)
        .select("row", "n_bytes", "text", F.row_number().over(same).alias("nth"))
        .where("nth = 1")
    )
    contexts = ws.land(
        once.join(wanted.hint("merge"), ["row", "n_bytes"])
        .select("row", "n_bytes", "wanted", "text")
        .mapInArrow(_cut_contexts(length), CONTEXT),
        "contexts",
    )
    ws.drop("classes", "hits")

    split, rounds = ["gram", "key", "low", "high"], 0
    parts = ["span-copies"]

    def kept_spans(found: DataFrame, name: str) -> None:
        parts.append(f"span-{name}-{rounds}")
        ws.land(found, parts[-1])

    while True:
        sizes = contexts.groupBy(*split).agg(F.count("*").alias("size"))
        many = F.col("size") > group
        small = contexts.join(sizes.where((F.col("size") > 1) & ~many).select(*split).hint("merge"), split, "left_semi")
        kept_spans(small.repartition("gram", "key").sortWithinPartitions(*split).mapInArrow(_sort_groups(length), SPAN), "sorted")
        large = ws.land(sizes.where(many).select(*split), f"large-{rounds}")
        if large.isEmpty():
            break
        halves = ws.land(
            contexts.join(large.hint("merge"), split, "left_semi")
            .select(*contexts.columns)
            .mapInArrow(_halves(length), f"{CONTEXT}, reach long"),
            f"halves-{rounds}",
        )
        whole = [*split, "reach"]
        agreed = ws.land(
            halves.where("reach IS NOT NULL")
            .groupBy(*whole)
            .agg(F.count("*").alias("size"), F.min(F.struct("row", "n_bytes", "pos")).alias("one"))
            .where("size > 1"),
            f"agreed-{rounds}",
        )
        joined = halves.join(agreed.hint("merge"), whole, "left")
        kept_spans(
            joined.where("size IS NOT NULL AND n = 1").select(
                "row", "n_bytes", (F.col("pos") - F.col("high")).alias("start"), (F.col("pos") - F.col("low") + length).alias("end")
            ),
            "agreed",
        )
        first = F.struct("row", "n_bytes", "pos") == F.col("one")
        contexts = ws.land(
            joined.where(F.col("size").isNull() | first).withColumn("n", F.coalesce("size", "n")).select(*contexts.columns),
            f"contexts-{rounds}",
        )
        ws.drop(f"halves-{rounds}", "contexts" if not rounds else f"contexts-{rounds - 1}")
        rounds += 1
    spans = docs.sparkSession.read.schema(SPAN).parquet(*[f"{ws.root}/{part}" for part in parts])
    by_start = Window.partitionBy("row", "n_bytes").orderBy("start", "end")
    reached = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        spans.withColumn("new", F.coalesce((F.col("start") > reached).cast("int"), F.lit(1)))
        .withColumn("run", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "n_bytes", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("row", "n_bytes")
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )
    return (
        texts.join(runs.hint("merge"), ["row", "n_bytes"], "left")
        .select("doc_id", "n_bytes", "text", "spans")
        .mapInArrow(_remove, REMOVED)
    )
