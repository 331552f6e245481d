"""SimHash near duplicates against plain fingerprints and all pairs."""

import random

import pytest
import xxhash
from helpers import table

from eventlayers.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """The smallest fingerprint that each reaches by steps of two or fewer bits."""
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    some = sorted(prints)
    for i, a in enumerate(some):
        for b in some[:i]:
            if (a ^ b).bit_count() <= 2 and find(a) != find(b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {f: find(f) for f in prints}


def expected(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = groups(set(prints))
    least = {}
    for (i, _), f in zip(rows, prints):
        known = [x for x in (i, least.get(root[f])) if x is not None]
        least[root[f]] = min(known, default=None)
    return sorted(((i, f"{f:016x}", least[root[f]]) for (i, _), f in zip(rows, prints)), key=repr)


def test_whole_table_and_awkward_rows(frame, texts):
    for cell_rows in (simhash.CELL_ROWS, 1):
        assert table(simhash.near_duplicates(frame, cell_rows)) == expected(texts)


def test_near_texts_link_and_clean_ones_do_not(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    base = [word() for _ in range(3000)]
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join([*base[:1500], "other", *base[1501:]]))]
    rows += [(k, " ".join(word() for _ in range(300))) for k in range(10, 40)]
    rows += [(90, None), (91, "  "), (92, "")]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1] == got[2] == 1 and got[90] == got[91] == got[92] == 90
    assert {k: v for k, v in got.items() if 10 <= k < 40} == {k: k for k in range(10, 40)}
    assert sorted(got.items()) == [(i, c) for i, _, c in sorted(expected(rows))]


@pytest.mark.parametrize("cell_rows", [1, 3, 128])
def test_crowded_cells_lose_no_link(spark, cell_rows):
    """Clusters that fill cells, chains of two-bit steps, and pairs at exactly two and three bits."""
    rng = random.Random(cell_rows)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        prints |= {centre} | {centre ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(60)}
        step = centre ^ rng.getrandbits(64)
        for _ in range(10):
            step ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.add(step)
    for bits in (2, 3):
        a = rng.getrandbits(64)
        prints |= {a, a ^ sum(1 << b for b in rng.sample(range(64), bits))}
    prints |= {0, (1 << 64) - 1, 1 << 63, 3, (1 << 64) - 4}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint").repartition(4)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in simhash.fingerprint_links(frame, cell_rows).collect():
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= 2
        low, high = sorted((find(a), find(b)))
        root[high] = low
    assert {p: find(p) for p in prints} == groups(prints)


def test_empty_table_clashing_columns(empty, spark):
    assert simhash.near_duplicates(empty).collect() == []
    row = spark.createDataFrame([(1, "a b c", "x", 1, 2)], "doc_id int, text string, fp string, n int, component_id int")
    assert table(simhash.near_duplicates(row)) == [(1, f"{plain_fingerprint('a b c'):016x}", 1)]
