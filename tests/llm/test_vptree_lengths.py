"""Vectors of several lengths, and ids with several vectors, against all distances."""

import random

import numpy as np
import pytest
from test_vptree import found, frame_of, same

from eventlayers.llm import vptree


def brute(rows, k=10):
    near = {}
    for q, x in rows:
        for i, y in rows:
            if q % 5 == 0 and i != q and len(x) == len(y):
                d = float(np.sqrt(((np.array(x) - np.array(y)) ** 2).sum()))
                near.setdefault(q, {})[i] = min(near.get(q, {}).get(i, np.inf), d)
    return {(q, r + 1, i, d) for q, m in near.items() for r, (d, i) in enumerate(sorted((d, i) for i, d in m.items())[:k])}


@pytest.mark.parametrize("shard_rows", [1000, 15])
def test_each_length_is_searched(spark, shard_rows):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(3 + i % 3)]) for i in range(120)] + [(500, [1.0] * 40)]
    got = found(frame_of(spark, rows), shard_rows=shard_rows)
    same(got, brute(rows))
    assert {r[0] for r in got} == set(range(0, 120, 5))


@pytest.mark.parametrize("shard_rows", [1000, 20])
def test_an_id_with_several_vectors_takes_one_place(spark, shard_rows):
    rng = random.Random(6)
    rows = [(i, [float(i), rng.random()]) for i in range(1, 60)]
    rows += [(i, [i + 0.01 * k, 0.5]) for i in range(1, 60, 2) for k in range(12) if i % 5]
    same(found(frame_of(spark, rows), shard_rows=shard_rows), brute(rows))
    tree = vptree.Tree(np.array([1, 1, 1, 2, 3]), np.array([[1.0], [1.1], [1.2], [5.0], [9.0]]), 2)
    ids, dist = tree.search(7, np.array([1.0]), 2, 1.0)
    assert ids.tolist() == [1, 2] and dist.tolist() == [0.0, 4.0]
