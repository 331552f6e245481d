"""Nearest neighbours with vantage-point trees, one per shard.

Vectors of each length are dealt to shards of about `shard_rows`; each shard builds a tree whose inner nodes hold a vantage
point, the distances from it at which its nearer half ends and its farther half begins, and whose leaves hold blocks
of vectors. Each tree goes to one task, and the queries pass by it in batches; a side is skipped where the triangle
inequality, relaxed by `relax`, says that it holds nothing nearer than the query's tenth best so far. At factor one nothing nearer is ever skipped; above one the
best distance counts as so many times smaller, so more is skipped. Reported distances are exact.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlayers.llm.common import materialise

SHARD_ROWS = 20_000
LEAF_ROWS = 128
NEIGHBOURS = 10
RELAX = 1.0


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def distances(query: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(points - query).sum(axis=-1))


class Tree:
    """Points in leaf order; nodes are (vantage row, end of the inner half, start of the outer half, inner, outer) or
    (first, last) of a leaf's rows. Halves are by count, so ties are halved too."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order: list[np.ndarray] = []
        self.nodes: list[tuple] = []
        self.leaf_rows = leaf_rows
        self._placed = 0
        self._build(np.arange(len(ids)), points, order)
        rows = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.ids, self.points = ids[rows], points[rows]
        self.repeats = len(np.unique(ids)) < len(ids)

    def _build(self, rows: np.ndarray, points: np.ndarray, order: list[np.ndarray]) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if len(rows) > self.leaf_rows:
            vantage, rest = rows[0], rows[1:]
            far = distances(points[vantage], points[rest])
            by_distance = np.argsort(far, kind="stable")
            inner, outer = np.split(by_distance, [len(rest) // 2])
            place = self._place(rows[:1], order)
            a = self._build(rest[inner], points, order)
            b = self._build(rest[outer], points, order)
            self.nodes[at] = (place, float(far[inner[-1]]), float(far[outer[0]]), a, b)
            return at
        place = self._place(rows, order)
        self.nodes[at] = (place, place + len(rows))
        return at

    def _place(self, rows: np.ndarray, order: list[np.ndarray]) -> int:
        order.append(rows)
        self._placed += len(rows)
        return self._placed - len(rows)

    def search(self, own: int, query: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest ids other than `own`, each once, and their least distances; ties go to the smaller id."""
        ids, dist = np.zeros(0, np.int64), np.zeros(0)
        worst = math.inf

        def offer(first: int, last: int) -> np.ndarray:
            nonlocal ids, dist, worst
            far = distances(query, self.points[first:last])
            near = (far <= worst) & (self.ids[first:last] != own)
            if near.any():
                ids = np.concatenate([ids, self.ids[first:last][near]])
                dist = np.concatenate([dist, far[near]])
                if len(ids) > k or self.repeats:
                    best = np.lexsort((ids, dist))
                    if self.repeats:
                        best = best[np.sort(np.unique(ids[best], return_index=True)[1])]
                    ids, dist = ids[best[:k]], dist[best[:k]]
                if len(ids) == k:
                    worst = float(dist.max())
            return far

        stack: list[tuple[int, float]] = [(0, 0.0)]
        while stack:
            at, bound = stack.pop()
            # Rounding may make a bound too large by a few units in the last place.
            if bound * relax * (1 - 1e-12) > worst:
                continue
            node = self.nodes[at]
            if len(node) == 2:
                offer(*node)
                continue
            place, ends, begins, inner, outer = node
            far = float(offer(place, place + 1)[0])
            sides = [(inner, max(bound, far - ends)), (outer, max(bound, begins - far))]
            stack += sides if far > (ends + begins) / 2 else sides[::-1]
        return ids, dist


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    k: int = NEIGHBOURS,
    relax: float = RELAX,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: the k nearest vectors of every row that the condition `queries` chooses.

    Columns `vec_id` and `embedding` are read. Rows with a null id, or with a vector that is null, empty, zero or
    not finite, take no part. Vectors are neighbours of vectors of their own length only, whatever lengths occur.
    They may repeat and tie (smaller ids first); an id with several vectors is one candidate, at the least distance
    of any of them, and never for its own id. Fewer candidates than k give fewer rows; an empty table gives none.
    """
    double = F.col("embedding").cast("array<double>")
    rows = vectors.where(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), double.alias("v"), queries.alias("asks")
    ).where(usable(F.col("v")))
    rows = rows.withColumn("width", F.size("v"))
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    # One row per length; a length without queries needs no trees.
    sizes = materialise(
        rows.groupBy("width").agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).where(F.col("q") > 0)
        .select("width", F.ceil(F.col("n") / shard_rows).alias("shards")),
        "vector-lengths",
    )
    if sizes.isEmpty():
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.join(F.broadcast(sizes), "width")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.col("shards")).cast("int"))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id", kind="stable")
        # Adding zero makes the negative zero a plain one.
        points = np.array(part["v"].tolist(), np.float64).reshape(len(part), -1) + 0.0
        ids = part["vec_id"].to_numpy(np.int64)
        once: dict[tuple[int, bytes], int] = {}
        for at, (i, p) in enumerate(zip(ids.tolist(), points)):
            once.setdefault((i, p.tobytes()), at)
        first = np.random.default_rng(7).permutation(np.fromiter(once.values(), np.int64, len(once)))
        tree = Tree(ids[first], points[first])
        one = part[["width", "shard"]].iloc[:1].reset_index(drop=True)
        return one.assign(tree=[pickle.dumps(tree)])

    index = materialise(
        rows.groupBy("width", "shard").applyInPandas(build, "width int, shard int, tree binary"),
        "vantage-trees",
    )
    asked = rows.where("asks").select(
        "width", F.explode(F.sequence(F.lit(0), (F.col("shards") - 1).cast("int"))).alias("shard"),
        F.lit(None).cast("binary").alias("tree"), "vec_id", "v",
    )
    trees = index.select("width", "shard", "tree", F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("array<double>").alias("v"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: Tree | None = None
        for batch in batches:
            out: list[tuple[int, int, float]] = []
            for packed, own, v in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4)):
                if packed.is_valid:
                    tree = pickle.loads(packed.as_buffer())
                else:
                    ids, dist = tree.search(own, v.values.to_numpy(), k, relax)
                    out += zip([own] * len(ids), ids.tolist(), dist.tolist())
            columns = zip(*out) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"]
            )

    # The tree of a shard comes before its queries: nulls sort first.
    found = (
        trees.unionByName(asked).repartition("width", "shard").sortWithinPartitions("width", "shard", "vec_id")
        .mapInArrow(search, "query_id bigint, vec_id bigint, score double")
    )
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return (
        best.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
