"""Vantage-point search against all distances."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlayers.llm import vptree


def brute(rows, asks, k):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    width = max((len(v) for _, v in good), default=0)
    good = [(i, np.array(v)) for i, v in good if len(v) == width]
    out = set()
    for q, x in good:
        if asks(q):
            near = {}
            for i, y in good:
                if i != q:
                    d = float(np.sqrt(((x - y) ** 2).sum()))
                    near[i] = min(near.get(i, math.inf), d)
            out |= {(q, r + 1, i, d) for r, (d, i) in enumerate(sorted((d, i) for i, d in near.items())[:k])}
    return out


def found(frame, **kw):
    return {tuple(r) for r in vptree.nearest_neighbours(frame, F.col("vec_id") % 5 == 0, **kw).collect()}


def same(got, want):
    got, want = sorted(got), sorted(want)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-12)


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, 0.5) for i, v in rows], "vec_id bigint, embedding array<double>, score double").repartition(3)


@pytest.mark.parametrize("shard_rows", [1000, 40])
def test_exact_at_factor_one(spark, shard_rows):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 4, 1) for _ in range(6)]) for i in range(300)]
    rows += [(300 + i, [1.0, 2.0, 3.0, 0.0, 0.0, 0.0]) for i in range(30)]
    rows += [
        (400, None), (401, [0.0] * 6), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (403, [math.nan] * 6), (404, [math.inf] * 6),
        (405, []), (406, [1.0]), (None, [1.0] * 6), (5, rows[5][1]), (10, rows[10][1]),
    ]
    same(
        found(frame_of(spark, rows), shard_rows=shard_rows),
        brute(rows, lambda i: i % 5 == 0, 10),
    )


def test_large_ids_that_share_a_vector(spark):
    """As doubles these ids are one number; they stay neighbours of their own."""
    rows = [(2**60 + k, [1.0, 2.0]) for k in range(4)] + [(2**60 + 1, [1.0, 2.0]), (100, [1.0, 2.5]), (7, [-0.0, 3.0]), (7, [0.0, 3.0])]
    same(found(frame_of(spark, rows)), brute(rows, lambda i: i % 5 == 0, 10))
    ids = [r.vec_id for r in vptree.nearest_neighbours(frame_of(spark, rows), F.col("vec_id") == 100).orderBy("rank").collect()]
    assert ids == [*(2**60 + k for k in range(4)), 7]


@pytest.mark.parametrize("shard_rows", [5000, 400])
def test_all_distances_tie(spark, shard_rows):
    """One-hot vectors, all equally far from each other: trees of halves, answers by id."""
    rows = [(k, [float(j == k % 30) for j in range(30)]) for k in range(900)]
    same(found(frame_of(spark, rows), shard_rows=shard_rows, k=40), brute(rows, lambda i: i % 5 == 0, 40))
    points = np.eye(1000)
    tree = vptree.Tree(np.arange(1000), points)
    assert max(n[1] - n[0] for n in tree.nodes if len(n) == 2) <= vptree.LEAF_ROWS


def test_few_candidates_and_none(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(3)]
    same(found(frame_of(spark, rows)), brute(rows, lambda i: i % 5 == 0, 10))
    assert found(frame_of(spark, rows[:1])) == set()
    assert found(spark.createDataFrame([], "vec_id bigint, embedding array<float>")) == set()


def test_large_trees_split_and_relaxing_skips(spark):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(3000, 5))
    tree = vptree.Tree(np.arange(3000), points)
    assert len(tree.nodes) > 20
    hits = {1.0: 0, 1.5: 0, 3.0: 0}
    for q in range(0, 3000, 60):
        d = vptree.distances(points[q], points)
        d[q] = np.inf
        best = set(np.argsort(d, kind="stable")[:10].tolist())
        for relax in hits:
            hits[relax] += len(best & set(tree.search(q, points[q], 10, relax)[0].tolist()))
    assert hits[1.0] == 500 and 450 <= hits[1.5] <= 500 and hits[3.0] <= hits[1.5]


def test_recall_on_the_shared_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in vectors.collect()]
    got = {tuple(r) for r in vptree.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0).collect()}
    want = brute(rows, lambda i: i % 100 == 0, 10)
    assert len({r[:3] for r in got} & {r[:3] for r in want}) / len(want) >= 0.9
    same(got, want)
