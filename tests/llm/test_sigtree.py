"""The signature-tree join against all pairs."""

import random

import numpy as np
import pytest
from helpers import table

from eventlayers.llm import sigtree


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
                o = len(x & y)
                if 100 * o >= 80 * (len(x) + len(y) - o):
                    root[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    least = {r: min((m for m in ms if m is not None), default=None) for r, ms in members.items()}
    return sorted(((rows[i][0], len(s), least[find(i)] if s else rows[i][0]) for i, s in enumerate(sets)), key=repr)


def planted(seed=4):
    """Chains of edits around the bound, groups of near copies, shared passages, and equal sets in other words' order."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(200))
    passage = [word() for _ in range(60)]
    rows = []

    def add(words):
        rows.append((1000 + len(rows), " ".join(words)))

    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 4, 5, 6, 9, 14, 30, 100, 400]))]
        for _ in range(rng.randint(1, 7)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 30))):
                copy[rng.randrange(len(copy))] = word()
            add(copy)
            if rng.random() < 0.5:
                base = copy
    for _ in range(30):
        add([word() for _ in range(rng.randint(0, 40))] + passage + [word() for _ in range(rng.randint(0, 20))])
    add(["x"] * 50)
    add(["x"] * 9)
    add(["X"] * 5)
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows(texts):
    return [*texts, *planted()]


@pytest.mark.parametrize("bucket_rows, lot_bytes", [(800, 1 << 20), (3, 20_000)])
def test_components(spark, rows, bucket_rows, lot_bytes):
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, cls int").repartition(6)
    got = table(sigtree.similar_documents(frame, bucket_rows, lot_bytes))
    assert got == brute(rows)


def test_one_row_of_each_component_stays(spark, rows):
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, cls int").repartition(6)
    kept = sigtree.one_of_each(frame)
    assert kept.columns == ["doc_id", "text", "cls"]
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert set(found) <= set(rows)
    wordless = [r for r in rows if not shingles(r[1])]
    assert sorted((r for r in found if not shingles(r[1])), key=repr) == sorted(wordless, key=repr)
    worded = [r for r in found if shingles(r[1])]
    assert brute(worded) == sorted(((i, len(shingles(t)), i) for i, t in worded), key=repr)
    every = [r for r in rows if shingles(r[1])]
    together = brute(every)
    roots = {c for _, _, c in together}
    assert {i for i, _ in worded} == roots


def test_counts_of_many_tasks_are_summed_in_rounds(spark):
    """Any number of tasks, some with the same counts: rounds of a few rows give what one round gives."""
    rng = np.random.default_rng(5)
    each = [rng.integers(0, 50, 1 << sigtree.COUNT_BITS, dtype=np.uint32) * (rng.random(1 << sigtree.COUNT_BITS) < 0.01) for _ in range(3)]
    each = [*each, each[0], each[0]]
    rows = [r for c in each for r in zip(*sigtree.count_rows(c.astype(np.uint32)))]
    slices = spark.createDataFrame(rows, "slice int, counts binary").repartition(8)
    total = sum(c.astype(np.float64) for c in each)
    usual = 1 + np.floor(4 * np.log2(total.mean() + 6 * np.sqrt(total.mean()) + 8))
    logs = np.where(total > 0, 1 + np.floor(4 * np.log2(np.maximum(total, 1))), 0)
    want = np.where(logs > usual, logs, total > 0).astype(np.uint8)
    for at_once in (2, 256):
        assert (sigtree.summed_counts(slices, at_once) == want).all()


def test_frequent_shingles_come_last(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    _, frequent = sigtree.shingle_sets(frame)
    frequent = np.where(np.arange(len(frequent)) % 3 == 0, 9, frequent).astype(np.uint8)
    routes = sigtree.prefix_tokens(frame, frequent)
    roots = sigtree.components(sigtree.class_links(frame, sigtree.shared_buckets(routes), 800, 1 << 20))
    plain, classes = sigtree.class_roots(frame)
    linked = classes.groupBy("root").count().where("count > 1").join(classes, "root")
    assert table(roots.selectExpr("node", "root")) == table(
        linked.where("cls <> root").selectExpr("cls node", "root")
    )


@pytest.mark.parametrize("seed", range(15))
def test_trees_lose_no_link(seed):
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    sets = []
    for _ in range(70):
        base = sets[rng.integers(len(sets))] if sets and rng.random() < 0.7 else pool[rng.random(len(pool)) < rng.random()]
        keep = base[rng.random(len(base)) < rng.choice([0.8, 0.9, 0.97])]
        sets.append(np.unique(np.append(keep, pool[rng.integers(len(pool), size=rng.integers(1, 9))])))
    linked = lambda x, y: 9 * sigtree.overlap(x, y) >= 4 * (len(x) + len(y))
    for side in (np.zeros(70, int), rng.integers(0, 2, 70)):
        label = list(range(70))
        want = list(range(70))
        for links, into in (
            (sigtree.bucket_links(sets, side), label),
            ([(i, j) for i in range(70) for j in range(i) if (side[i] != side[j] or not side.any()) and linked(sets[i], sets[j])], want),
        ):
            for i, j in links:
                a, b = into[i], into[j]
                into[:] = [min(a, b) if x in (a, b) else x for x in into]
        assert label == want


@pytest.mark.parametrize("seed", range(6))
def test_clusters_lose_no_link(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(60):
        n = int(np.exp(rng.uniform(0, 7.5))) + 1
        base = sets[rng.integers(len(sets))] if sets and rng.random() < 0.6 else rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        keep = np.unique(base[rng.random(len(base)) < rng.choice([0.8, 0.9, 0.99])])
        sets.append(keep if len(keep) else np.unique(base))
    marks = [sigtree.signature(b"", s) for s in sets]
    sizes = np.array([m[0] for m in marks])
    first = np.array([s[0] for s in sets])
    maps = [np.frombuffer(m[2], np.uint64) for m in marks]
    for side in (np.zeros(60, int), rng.integers(0, 2, 60)):
        found = {frozenset((i, j)) for c in sigtree.bucket_clusters(sizes, first, maps, side) for i in c for j in c}
        for i in range(60):
            for j in range(i):
                if side[i] != side[j] or not side.any():
                    if 9 * sigtree.overlap(sets[i], sets[j]) >= 4 * (len(sets[i]) + len(sets[j])):
                        assert frozenset((i, j)) in found
    alone = [rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) for n in (300, 310, 320, 330)]
    marks = [sigtree.signature(b"", np.unique(s)) for s in alone]
    assert not sigtree.bucket_clusters(
        np.array([m[0] for m in marks]), np.array([s.min() for s in alone]),
        [np.frombuffer(m[2], np.uint64) for m in marks], np.zeros(4, int),
    )


def test_empty(empty):
    assert sigtree.similar_documents(empty).count() == 0
    assert sigtree.one_of_each(empty).count() == 0
