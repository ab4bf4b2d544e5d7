"""Approximate nearest neighbours over balanced posting lists.

Centroids are fitted by balanced k-means on a bounded sample and joined by a neighbour graph, which
is searched best first. Every vector goes to the list of its nearest centroid, boundary vectors to
further lists whose centroids are nearly as near. A query reads the lists whose centroid distance
is within a ratio of the nearest. Long lists are cut into pages, so no task holds a whole list.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import Workspace
from fleetspark.llm.vectors import finite_vectors, firsts_of_equal, matrix

SAMPLE = 20_000  # vectors that centroids are fitted on, at most
LIST_ROWS = 200  # sampled vectors of a list
GRAPH_LINKS, BEAM = 16, 64
REPLICAS, BOUNDARY = 3, 1.1
LISTS, RATIO = 48, 1.8
PAGE_ROWS = 4096


def balanced_centroids(sample: np.ndarray, count: int, rounds: int = 10) -> np.ndarray:
    """k-means whose assignment adds a penalty that grows with a list's size."""
    dealt = np.random.default_rng(11)
    centres = sample[dealt.choice(len(sample), count, replace=False)].copy()
    sizes = np.zeros(count)
    for _ in range(rounds):
        far = _squares(sample, centres)
        penalty = far.min(axis=1).mean() * 0.5 * (sizes / max(1.0, len(sample) / count) - 1)
        own = np.argmin(far + np.maximum(penalty, 0), axis=1)
        sizes = np.bincount(own, minlength=count).astype(float)
        for c in np.flatnonzero(sizes):
            centres[c] = sample[own == c].mean(axis=0)
    return centres


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0)


class CentroidGraph:
    """Each centroid is linked with its nearest ones and a ring, so every one can be reached."""

    def __init__(self, centres: np.ndarray):
        count = len(centres)
        self.centres = centres
        near = np.argsort(_squares(centres, centres), axis=1)[:, 1 : GRAPH_LINKS + 1]
        links = [set(row.tolist()) for row in near]
        for i in range(count):
            links[i].add((i + 1) % count)
            for j in near[i]:
                links[j].add(i)
        self.links = [np.array(sorted(x - {i}), np.int64) for i, x in enumerate(links)]

    def nearest(self, point: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Distances and numbers of about the nearest `count` centroids, nearest first."""
        beam = max(BEAM, count)
        first = float(np.sqrt(((self.centres[0] - point) ** 2).sum()))
        seen = np.zeros(len(self.centres), bool)
        seen[0] = True
        ahead, best = [(first, 0)], [(-first, 0)]
        while ahead:
            far, at = heapq.heappop(ahead)
            if len(best) == beam and far > -best[0][0]:
                break
            fresh = self.links[at][~seen[self.links[at]]]
            seen[fresh] = True
            for d, i in zip(np.sqrt(((self.centres[fresh] - point) ** 2).sum(1)).tolist(), fresh.tolist()):
                if len(best) < beam:
                    heapq.heappush(best, (-d, i))
                    heapq.heappush(ahead, (d, i))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, i))
                    heapq.heappush(ahead, (d, i))
        chosen = sorted((-d, i) for d, i in best)[:count]
        return np.array([d for d, _ in chosen]), np.array([i for _, i in chosen])


def _listed(graph: CentroidGraph, count: int, ratio: float):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lists = [], []
            for place, point in enumerate(matrix(batch.column("v"))):
                far, near = graph.nearest(point, count)
                kept = near[far <= ratio * far[0]]
                rows += [place] * len(kept)
                lists += kept.tolist()
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken.column("vec_id"), taken.column("v"), pa.array(lists, pa.int32())], ["vec_id", "v", "list"]
            )

    return run


def _nearest_in_list(k: int):
    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if rows.num_rows and asked.num_rows:
            points, ids = matrix(rows["v"]), rows["vec_id"].to_numpy()
            for query, own in zip(matrix(asked["v"]), asked["vec_id"].to_pylist()):
                far = np.sqrt(((points - query) ** 2).sum(axis=1))
                far[ids == own] = np.inf
                order = np.lexsort((ids, far))[:k]
                out += [(own, int(ids[i]), float(far[i])) for i in order if np.isfinite(far[i])]
        names, kinds = ("query_id", "vec_id", "score"), (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(names, kinds))})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: about the k nearest by Euclidean distance of each query.

    Null, zero and non-finite vectors and null ids take no part. Vectors should be of one length;
    those of another than the most common are left out of lists. Repeated rows count once; ties
    go to the smaller id. With no more candidates than one list holds the answer is exact.
    """
    ws = Workspace(vectors.sparkSession, "ann")
    once = finite_vectors(vectors, False).dropDuplicates(["vec_id", "v"])
    points = ws.land(firsts_of_equal(once, F.col("v"), k), "points")
    common = points.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = common["d"] if common else 0
    points = points.where(F.size("v") == dims)
    sample = np.array(
        [r["v"] for r in points.orderBy(F.xxhash64("vec_id"), "vec_id").select("v").limit(SAMPLE).collect()], float
    ).reshape(-1, max(dims, 1))
    graph = CentroidGraph(
        balanced_centroids(sample, max(1, len(sample) // LIST_ROWS)) if len(sample) else np.zeros((1, 1))
    )
    kind = "vec_id long, v array<double>, list int"
    listed = ws.land(points.mapInArrow(_listed(graph, REPLICAS, BOUNDARY), kind), "listed")
    pages = (
        listed.groupBy("list").count()
        .select("list", F.ceil(F.col("count") / PAGE_ROWS).cast("int").alias("pages"))
    )  # a row for each centroid: SAMPLE / LIST_ROWS at most
    paged = listed.join(F.broadcast(pages), "list").withColumn(
        "page", F.pmod(F.xxhash64("vec_id"), F.col("pages")).cast("int")
    )
    asked = (
        finite_vectors(queries, False).where(F.size("v") == dims).dropDuplicates(["vec_id", "v"])
        .mapInArrow(_listed(graph, LISTS, RATIO), kind)
        .join(F.broadcast(pages), "list")
        .withColumn("page", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
    )
    found = (
        paged.select("list", "page", "vec_id", "v").groupBy("list", "page")
        .cogroup(asked.select("list", "page", "vec_id", "v").groupBy("list", "page"))
        .applyInArrow(_nearest_in_list(k), "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))  # replicas
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
