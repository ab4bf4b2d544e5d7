"""Exact top-k inner products by KD-trees per shard.

Vectors are dealt to shards of a bounded size. Each shard builds a tree of median splits along its
widest axis with tight bounding boxes, and answers queries best box first: the bound of a box is
its largest possible inner product, and a box below the k-th score found so far is left out.
Every query first searches one shard; the k-th score found there travels with it to the others.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import Workspace
from fleetspark.llm.vectors import finite_vectors, firsts_of_equal, matrix

SHARD_ROWS = 4096
QUERY_ROWS = 512
LEAF_ROWS = 64
FOUND = "query_id long, vec_id long, score long"


class Tree:
    """Nodes in arrays; a node's rows are order[first:last]. Works on integer vectors."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        self.order = np.arange(len(points))
        self.points, self.ids = points, ids
        self.nodes: list[tuple[int, int, int, int]] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self._build(0, len(points))
        self.low_box, self.high_box = np.array(self.low), np.array(self.high)

    def _build(self, first: int, last: int) -> int:
        part = self.points[self.order[first:last]]
        number = len(self.nodes)
        self.nodes.append((first, last, -1, -1))
        low, high = part.min(axis=0), part.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        axis = int(np.argmax(high - low))
        if last - first > LEAF_ROWS and high[axis] > low[axis]:
            middle = (last - first) // 2
            halves = np.argpartition(part[:, axis], middle)
            self.order[first:last] = self.order[first:last][halves]
            left = self._build(first, first + middle)
            right = self._build(first + middle, last)
            self.nodes[number] = (first, last, left, right)
        return number

    def search(self, query: np.ndarray, own: int, k: int, floor: float) -> list[tuple[int, int]]:
        """(score, id) of the k best, the query's own id left out. Rows below `floor` are not
        wanted: k others are known to reach it. Equal scores go to the smaller id."""
        bounds = np.where(query > 0, self.high_box, self.low_box) @ query
        best: list[tuple[int, int]] = []  # a heap whose root is the worst: (score, -id)
        heap = [(-bounds[0], 0)]
        while heap:
            bound, number = heapq.heappop(heap)
            least = max(floor, best[0][0]) if len(best) == k else floor
            if -bound < least:
                break
            first, last, left, right = self.nodes[number]
            if left >= 0:
                for child in (left, right):
                    if bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            rows = self.order[first:last]
            scores = self.points[rows] @ query
            for place in np.flatnonzero(scores >= least):
                entry = (scores[place].item(), -int(self.ids[rows[place]]))
                if -entry[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(int(score), -negative) for score, negative in best]


def exact_type(queries: np.ndarray, points: np.ndarray) -> type:
    """Doubles while every partial sum is an exact integer, else Python's integers."""
    if not queries.size or not points.size:
        return float
    largest = float(np.abs(queries).max()) * float(np.abs(points).max()) * queries.shape[1]
    return float if largest < 2.0**53 else object


def _search(k: int):
    def run(shard: pa.Table, asked: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, int]] = []
        if shard.num_rows and asked.num_rows:
            points, queries = matrix(shard["v"]), matrix(asked["v"])
            kind = exact_type(queries, points)
            if kind is object:
                points, queries = (np.array([[int(x) for x in r] for r in m], object) for m in (points, queries))
            tree = Tree(points, shard["vec_id"].to_numpy())
            ids, floors = asked["query_id"].to_pylist(), asked["floor"].to_pylist()
            for query, own, floor in zip(queries, ids, floors):
                least = float("-inf") if floor is None else floor
                rows += [(own, found, score) for score, found in tree.search(query, own, k, least)]
        return pa.table(
            {
                name: pa.array([r[i] for r in rows], pa.int64())
                for i, name in enumerate(("query_id", "vec_id", "score"))
            }
        )

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score of the k largest inner products of floor(1024 x) vectors.

    `vectors` and `queries` have vec_id and embedding. Null vectors and ids, and vectors with null or
    non-finite components, take no part; so do vectors of another length than most queries'... each
    length is searched among itself. Repeated rows count once each; ties go to the smaller id.
    """
    ws = Workspace(vectors.sparkSession, "kdtree")

    def whole(rows: DataFrame) -> DataFrame:
        scaled = F.transform("v", lambda x: F.floor(x * 1024.0).cast("double"))
        return finite_vectors(rows, True).withColumn("v", scaled)

    key = F.xxhash64("v")
    points = firsts_of_equal(whole(vectors), F.col("v"), k).select("vec_id", "v", F.size("v").alias("dims"))
    points = ws.land(points, "points")
    shards = max(1, -(-points.count() // SHARD_ROWS))
    points = points.withColumn("shard", F.pmod(F.xxhash64("vec_id", key), F.lit(shards)).cast("int"))
    asked = whole(queries).select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("dims"))
    asked = ws.land(asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(64)).cast("int")), "asked")
    home = F.pmod(F.xxhash64("query_id", F.lit("home")), F.lit(shards)).cast("int")
    started = asked.select("query_id", "v", "dims", home.alias("shard"), F.lit(None).cast("double").alias("floor"))
    by = ("dims", "shard")
    first = ws.land(
        points.groupBy(*by).cogroup(started.groupBy(*by)).applyInArrow(_search(k), FOUND), "first"
    )
    floors = (
        first.groupBy("query_id")
        .agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least"))
        .select("query_id", F.when(F.col("n") >= k, F.col("least")).alias("floor"))
    )
    every = F.array_except(F.sequence(F.lit(0), F.lit(shards - 1)), F.array(home))
    others = (
        asked.join(floors, "query_id", "left")
        .select("query_id", "v", "dims", "floor", F.explode(every).alias("shard"))
    )
    rest = points.groupBy(*by).cogroup(others.groupBy(*by)).applyInArrow(_search(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        first.unionByName(rest)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
