"""Prefix trie of conversations by bursting containers.

A trie head is a sequence of first turns; its container holds the suffixes, the turns that follow,
of all conversations that begin so. Turns are known by 128-bit ids. The start is one container
under the textless root. Every container of more than `container` different suffixes bursts by
the next turn id: its head becomes a node, suffixes that are used up end there, the others go to
the containers of longer heads. Bursting counts and divides rows by head, so a hot first turn is
spread over all tasks. What remains is sorted within each container and swept: neighbours share a
number of turns, a stack of open nodes is popped to that depth, and a popped node is complete.

Conversations of equal turns are one suffix with a count, made before any container is, so a
conversation that a third of the ids share is one row. Leaves and savings of burst heads are sums
over the containers below them and over burst heads below them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import Workspace

GROUP, CONTAINER, ID_BLOCK = 20, 2_000, 1 << 16
WORD = r"[^\x20\x09-\x0D]+"
NONE = hashlib.sha256(b"").hexdigest()
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, above array<string>"
)
NODE_ARROW = pa.schema(
    [
        *((name, pa.int64()) for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
        ("ends_sha256", pa.string()), ("above", pa.list_(pa.string())),
    ]
)


def numbered_turns(rows: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), id (16 bytes), words of each turn; ties of a turn by role and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return turns.select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("pos"),
        F.unhex(F.md5(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text").cast("binary"))).alias("id"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )


def rebuilt(rows: DataFrame) -> DataFrame:
    """conv_id and its turns: the first of its group's conversation, then its own after as many."""
    own = (
        numbered_turns(rows)
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "id", "words"))).alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))
    )
    bases = own.where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head")
    )
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int").alias("taken")
    return (
        own.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), taken)
        .join(bases, "base", "left")
        .select(
            "conv_id",
            F.concat(
                F.coalesce(F.slice("head", F.lit(1), F.col("taken")), F.slice("turns", F.lit(1), F.lit(0))),
                F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns") - F.col("taken"), F.lit(0))),
            ).alias("turns"),
        )
    )


def _hash_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a path from its blocks of ids, which come in order; only the digest is kept."""
    path, digest = None, None
    for batch in batches:
        done: tuple[list, list] = ([], [])
        for name, ids in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist()):
            if name == path:
                digest.update(b"," + ids.encode())
                continue
            if digest is not None:
                done[0].append(path)
                done[1].append(digest.hexdigest())
            path, digest = name, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.string()), pa.array(done[1], pa.string())], ["path", "ends"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([digest.hexdigest()])], ["path", "ends"])


def _distinct_paths(ws: Workspace, sequences: DataFrame) -> DataFrame:
    """Each different sequence of turns: turns, n, conv (smallest id), ends (digest of all ids)."""
    keyed = ws.land(
        sequences.select("conv_id", "turns", F.md5(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "").cast("binary")).alias("path")),
        "paths",
    )
    paths = keyed.groupBy("path").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv"))
    blocks = (
        keyed.groupBy("path", F.floor(F.col("conv_id") / ID_BLOCK).alias("block"))
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    )
    ends = blocks.repartition("path").sortWithinPartitions("path", "block").select("path", "ids").mapInArrow(_hash_ids, "path string, ends string")
    # The smallest conversation stands for its path: its turns are read where it lies.
    one = keyed.select(F.col("conv_id").alias("conv"), "path", "turns")
    return ws.land(paths.join(one, ["path", "conv"]).join(ends, "path").select("conv", "n", "ends", "turns"), "suffixes")


def sweep(suffixes: list[dict], words: int) -> list[dict]:
    """The nodes under a head, itself first, from its suffixes, which this sorts.

    A suffix has ids and words of its turns, conv, n and ends. Children follow their parents, so
    sums over subtrees are made from the last node to the first.
    """

    def node(up: int | None, words: int) -> dict:
        return {"up": up, "words": words, "conv": None, "n": 0, "children": 0, "leaves": 0, "saved": 0, "ends": NONE}

    nodes, path, before = [node(None, words)], [0], ()
    for suffix in sorted(suffixes, key=lambda s: s["ids"]):
        ids = suffix["ids"]
        shared = next((i for i, (a, b) in enumerate(zip(before, ids)) if a != b), min(len(before), len(ids)))
        del path[shared + 1 :]
        for turn_words in suffix["words"][shared:]:
            nodes.append(node(path[-1], turn_words))
            path.append(len(nodes) - 1)
        end = nodes[path[-1]]
        end["n"], end["conv"], end["ends"] = suffix["n"], suffix["conv"], suffix["ends"]
        before = ids
    for closed in reversed(nodes):
        closed["leaves"] = closed["leaves"] or 1
        closed["saved"] += (closed["n"] - 1) * closed["words"]
        if closed["up"] is not None:
            up = nodes[closed["up"]]
            up["conv"] = closed["conv"] if up["conv"] is None else min(up["conv"], closed["conv"])
            up["children"] += 1
            for total in ("n", "leaves", "saved"):
                up[total] += closed[total]
    return nodes


def _sweep_containers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers come whole, one after the other."""

    def swept(held: list[dict]) -> Iterator[dict]:
        first = held[0]
        suffixes = [
            {**row, "ids": tuple(t["id"] for t in row["turns"]), "words": [t["words"] for t in row["turns"]]} for row in held
        ]
        depths: list[int] = []
        nodes = sweep(suffixes, first["words"])
        for node in nodes:
            inside = node["up"] is not None
            depths.append(depths[node["up"]] + 1 if inside else first["depth"])
            yield {
                "conv_id": node["conv"], "depth": depths[-1], "parent_conv_id": nodes[node["up"]]["conv"] if inside else None,
                "n_convs": node["n"], "n_children": node["children"], "n_leaves": node["leaves"],
                "saved_tokens": node["saved"], "ends_sha256": node["ends"], "above": None if inside else first["above"],
            }

    held: list[dict] = []
    for batch in batches:
        found: list[dict] = []
        for row in batch.to_pylist():
            if held and row["head"] != held[0]["head"]:
                found += swept(held)
                held = []
            held.append(row)
        if found:
            yield pa.RecordBatch.from_pylist(found, NODE_ARROW)
    if held:
        yield pa.RecordBatch.from_pylist(list(swept(held)), NODE_ARROW)


def prefix_trie(rows: DataFrame, container: int = CONTAINER) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without conv_id take no part; turns of one number are ordered by role, then text, and
    repeated rows are turns of their own. A null turn is the first, a null role or text is empty.
    Other columns are ignored; an empty table has no node. A task holds one container and the turn
    ids of whole conversations, some 30 bytes a turn.
    """
    ws = Workspace(rows.sparkSession, "trie")
    first = F.get("turns", F.lit(0))
    members = _distinct_paths(ws, rebuilt(rows)).select(
        F.lit("").alias("head"), F.array().cast("array<string>").alias("above"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("words"), "conv", "n", "ends", "turns",
    )
    heads, containers, burst = [], [], members
    while True:
        number = len(heads)
        heads.append(f"heads-{number}")
        landed_heads = ws.land(
            burst.groupBy("head", "above", "depth", "words").agg(
                F.min("conv").alias("conv"), F.sum("n").alias("n"), F.count_distinct(first["id"]).alias("children"),
                F.max(F.when(F.size("turns") == 0, F.col("ends"))).alias("ends"),
            ),
            heads[-1],
        )
        below = ws.land(
            burst.where(F.size("turns") > 0).select(
                F.md5(F.concat("head", F.hex(first["id"])).cast("binary")).alias("head"),
                F.concat("above", F.array("head")).alias("above"), (F.col("depth") + 1).alias("depth"),
                first["words"].alias("words"), "conv", "n", "ends",
                F.slice("turns", F.lit(2), F.size("turns") - 1).alias("turns"),
            ),
            f"below-{number}",
        )
        large = ws.land(below.groupBy("head").count().where(F.col("count") > container).select("head"), f"large-{number}")
        containers.append(f"containers-{number}")
        if large.isEmpty():
            containers[-1] = f"below-{number}"
            break
        ws.land(below.join(large, "head", "left_anti").select(*below.columns), containers[-1])
        burst = ws.land(below.join(large, "head", "left_semi").select(*below.columns), f"burst-{number}")
        ws.drop(f"below-{number}", f"burst-{number - 1}")
    spark = rows.sparkSession
    rest = spark.read.schema(members.schema).parquet(*[f"{ws.root}/{name}" for name in containers])
    nodes = ws.land(
        rest.repartition("head").sortWithinPartitions("head").mapInArrow(_sweep_containers, NODE), "nodes"
    )
    ws.drop(*containers)
    head = spark.read.schema(landed_heads.schema).parquet(*[f"{ws.root}/{name}" for name in heads])
    saved = (F.col("n") - 1) * F.col("words")
    below_heads = (
        nodes.where("above IS NOT NULL").select("above", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
        .unionByName(head.select("above", F.lit(0).cast("long").alias("leaves"), saved.alias("saved")))
        .select(F.explode("above").alias("head"), "leaves", "saved")
        .groupBy("head").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )
    up = F.element_at("above", -1)
    top = head.join(below_heads, "head", "left").select(
        F.col("conv").alias("conv_id"), "depth", F.lit(None).cast("long").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.when(F.col("children") == 0, F.lit(1)).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
        (F.coalesce("saved", F.lit(0)) + (F.col("n") - 1) * F.col("words")).cast("long").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NONE)).alias("ends_sha256"), "above",
    )
    parents = head.select(F.col("head").alias("up"), F.col("conv").alias("parent"))
    edge = (
        nodes.where("above IS NOT NULL").unionByName(top)
        .withColumn("up", F.when(F.size("above") > 0, up))
        .join(parents, "up", "left")
        .withColumn("parent_conv_id", F.col("parent"))
    )
    columns = [c for c in nodes.columns if c != "above"]
    return nodes.where("above IS NULL").select(*columns).unionByName(edge.select(*columns))
