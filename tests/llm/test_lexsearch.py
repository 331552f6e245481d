"""Ranked lexical search against plain scores of every document."""

import math
import re
from collections import Counter

import pyarrow.parquet as pq
from helpers import table

from eventlayers.llm import lexsearch

PLAIN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(PLAIN))


def expected(rows, items, k=50):
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    held = Counter(t for _, c, _ in docs for t in c)
    total = sum(n for _, _, n in docs)
    own = {}
    for item, text in items:
        own.setdefault(item, set()).update(terms(text))
    out = []
    for item, some in own.items():
        scored = []
        for i, c, n in docs:
            m = 50 + 50 * n * len(docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * held[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in some
                if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def items_of():
    found = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    return [*zip(found["item_id"], found["text"]), (None, "a text without an id 東京"), (900, None), (901, "---"), (902, "facade façade The the THE")]


def test_whole_table_and_awkward_rows(spark, frame, texts):
    items = items_of()
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, rank int")
    want = expected(texts, items)
    assert len(want) > 500
    assert table(lexsearch.lexical_search(frame, asked)) == want
    # Blocks of items, and few places.
    assert table(lexsearch.lexical_search(frame, asked, block_bytes=1500)) == want
    assert table(lexsearch.lexical_search(frame, asked, k=3)) == expected(texts, items, 3)


def test_classes_of_copies_fill_the_ranks_by_id(spark):
    """Hundreds of equal bags (other words differ, order differs), and a second class of the same score."""
    rows = [(k, f"alpha beta x{k} gamma") for k in range(300, 0, -1)] + [(k, f"Gamma, q{k} beta; ALPHA") for k in range(1000, 1200)]
    rows += [(500 + k, "alpha alpha alpha beta") for k in range(3)] + [(k, "delta " * k) for k in range(1, 40)] + [(7, "alpha"), (7, "alpha")]
    items = [("a", "alpha beta"), ("b", "gamma"), ("c", "delta alpha"), ("c", "beta"), ("none", "zzz")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(6)
    asked = spark.createDataFrame(items, "item_id string, text string")
    got = lexsearch.lexical_search(docs, asked)
    assert table(got) == expected(rows, items)
    assert [r.doc_id for r in got.where("item_id = 'b'").orderBy("rank").collect()] == list(range(1, 51))


def test_terms():
    text = "A-b_c é٣🙂x 12'3\x7fÀB\x00z\x80"
    assert [t.decode() for t in lexsearch.terms(text.encode())] == terms(text)


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    assert lexsearch.lexical_search(empty, items).collect() == []
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id int, text string")
    assert lexsearch.lexical_search(docs, items.limit(0)).collect() == []
    assert [tuple(r)[:3] for r in lexsearch.lexical_search(docs, items).collect()] == [(1, 1, 1)]
