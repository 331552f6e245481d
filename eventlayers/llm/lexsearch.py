"""Ranked lexical search with bag deduplication.

A score depends on a document only through the frequencies of the items' terms in it and the length number m. So
documents are restricted to the vocabulary of the items, and those with the same frequencies and the same m are one
class, found by hash and verified by the frequencies themselves. Classes are scored once, and only classes that
reach an item's best are expanded to their members.

1. One pass over the texts leaves the term count and the bag of each document: numbers of terms and their frequencies.
2. Documents, terms and documents of each term are counted over all rows; they give the weights.
3. Each task keeps the best classes of each item by (score, smallest id). The k best documents are in the k best
   classes: each of k classes ahead of a class has its own smallest id ahead of all members of that class.
4. Members of these classes, the k smallest ids of each, are ranked.

Items are taken in blocks of `BLOCK_BYTES` of text, so that what is broadcast (a vocabulary and its weights) and what
a task keeps has a bound; more items are more passes over the documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventlayers.llm.common import id_and_text, materialise, row_schema, text_bytes

BEST = 50
BLOCK_BYTES = 1 << 20
#: Gains (terms times classes) that are held at once.
HELD_GAINS = 4 << 20

# A-Z to a-z, letters and digits and all of other bytes kept, every other ASCII byte to a space.
_TERMS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes) -> list[bytes]:
    """The terms of a text: runs of ASCII letters and digits and of all other code points beyond ASCII."""
    return text.translate(_TERMS).split()


def bags(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """`doc_id, n, terms, tfs`: the number of terms, and the vocabulary's terms in the text with their frequencies."""
    spark = docs.sparkSession
    numbers = spark.sparkContext.broadcast({t: k for k, t in enumerate(vocabulary)})
    schema = row_schema(docs, "n bigint, terms array<int>, tfs array<bigint>")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value.get
        for batch in batches:
            sizes, found, counts = [], [], []
            for text in text_bytes(batch.column(1)):
                some = terms(text)
                bag = Counter(map(number, some))
                del bag[None]
                pairs = sorted(bag.items())
                sizes.append(len(some))
                found.append([t for t, _ in pairs])
                counts.append([n for _, n in pairs])
            columns = [batch.column(0), *(pa.array(c, t) for c, t in zip((sizes, found, counts), arrow.types[1:]))]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return id_and_text(docs).mapInArrow(run, schema)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def best_classes(classes: DataFrame, wanted: list[list[int]], weights: list[int], k: int) -> DataFrame:
    """`item, cid, score, low`: for each item (its place) the k best classes of each task, of those with a score above 0.

    `classes` has `cid, low, m, terms, tfs`.
    """
    shared = classes.sparkSession.sparkContext.broadcast((wanted, np.array(weights, np.int64)))
    low_type = classes.schema["low"].dataType
    schema = T.StructType.fromDDL("item int, cid bigint, score bigint").add("low", low_type)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weights = shared.value
        items = [np.array(t, np.int64) for t in wanted]
        step = max(1, HELD_GAINS // max(1, len(weights)))
        # Per item: scores, class ids, and smallest ids (with a flag that puts nulls last).
        kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, object)) for _ in items]
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                cid = part.column(0).to_numpy()
                low = np.array(part.column(1).to_pylist(), object)
                none = np.array([x is None for x in low], bool)
                sizes = part.column(3).value_lengths().to_numpy()
                rows = np.repeat(np.arange(len(cid)), sizes)
                term, tf = part.column(3).flatten().to_numpy(), part.column(4).flatten().to_numpy()
                m = part.column(2).to_numpy()[rows]
                gain = np.zeros((len(weights), len(cid)), np.int64)
                gain[term, rows] = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
                for i, own in enumerate(items):
                    score = gain[own].sum(axis=0)
                    old = kept[i]
                    hit = score > 0
                    if len(old[0]) >= k:
                        # Equal scores may still come first by id.
                        hit &= score >= old[0][-1]
                    hit = np.flatnonzero(hit)
                    if not len(hit):
                        continue
                    new = [np.concatenate(p) for p in zip(old, (score[hit], cid[hit], none[hit], low[hit]))]
                    ids = np.where(new[2], 0, new[3])
                    order = sorted(range(len(ids)), key=lambda j: (-new[0][j], new[2][j], ids[j]))[:k]
                    kept[i] = tuple(p[order] for p in new)
        for i, (score, cid, _, low) in enumerate(kept):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(score), pa.int32()), pa.array(cid), pa.array(score), pa.array(low.tolist(), arrow.types[3])], schema=arrow
                )

    return classes.select("cid", "low", "m", "terms", "tfs").mapInArrow(run, schema)


def _ranked(rows: DataFrame, by: list, within: str, k: int) -> DataFrame:
    """The first k rows of each `within`; each task sends only its own first k."""
    order = Window.partitionBy(within).orderBy(*by)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_block(docs: DataFrame, items: list[tuple[object, list[bytes]]], item_type: T.DataType, k: int) -> DataFrame:
    """The k best documents of each of the items (id and distinct terms)."""
    spark = docs.sparkSession
    vocabulary = sorted({t for _, own in items for t in own})
    number = {t: i for i, t in enumerate(vocabulary)}
    rows = materialise(bags(docs, vocabulary), "bags")
    total = rows.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"], total["terms"] or 0
    holding = dict(rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = [weight(n_docs, holding.get(i, 0)) for i in range(len(vocabulary))]
    m = (F.lit(100 - 50) + F.expr(f"(50 * n * {n_docs}L) div {max(1, n_terms)}L")).cast("long")
    bag = ["h", "m", "terms", "tfs"]
    rows = rows.where(F.size("terms") > 0).select("doc_id", m.alias("m"), "terms", "tfs")
    rows = rows.withColumn("h", F.xxhash64("m", "terms", "tfs"))
    # Equal hashes meet, and only equal bags become one class.
    classes = rows.groupBy(*bag).agg(F.min("doc_id").alias("low"))
    classes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "bag-classes")
    first = [F.desc("score"), F.asc_nulls_last("low"), F.asc("cid")]
    found = best_classes(classes, [[number[t] for t in own] for _, own in items], weights, k)
    best = materialise(_ranked(found, first, "item", k).select("item", "cid", "score"), "best-classes")
    # At most k classes for each item of the block, whatever the number of documents.
    chosen = F.broadcast(classes.join(F.broadcast(best.select("cid").distinct()), "cid", "left_semi").select("cid", *bag))
    same = [rows[c].eqNullSafe(chosen[c]) for c in bag]
    members = rows.join(chosen, reduce(lambda x, y: x & y, same)).select("cid", "doc_id")
    members = _ranked(members, [F.asc_nulls_last("doc_id")], "cid", k).select("cid", "doc_id")
    places = _ranked(best.join(members, "cid"), [F.desc("score"), F.asc_nulls_last("doc_id")], "item", k)
    named = spark.createDataFrame(
        [(i, item_id) for i, (item_id, _) in enumerate(items)],
        T.StructType().add("item", T.IntegerType()).add("item_id", item_type),
    )
    return places.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def lexical_search(docs: DataFrame, items: DataFrame, k: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`item_id, rank, doc_id, score`: the k documents with the highest scores above 0 for each item; ties by id.

    Columns `doc_id, text` and `item_id, text` are read; others are left behind. Null or empty texts have no terms: such
    documents are never found and do not count, such items find nothing. Rows with one item id (null among them) are one
    item with the terms of all. Rows that repeat a text or a document id are documents of their own and take a rank
    each; a null document id comes last among equal scores. Empty tables give no rows.
    """
    spark = docs.sparkSession
    item_type = items.schema["item_id"].dataType
    asked = items.where(F.octet_length("text") > 0).select("item_id", "text")
    size = asked.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    found = None
    for block in range(blocks):
        own: dict[object, set[bytes]] = {}
        for r in asked.where(F.col("block") == block).toLocalIterator():
            own.setdefault(r["item_id"], set()).update(terms(r["text"].encode()))
        chosen = [(i, sorted(t)) for i, t in sorted(own.items(), key=repr) if t]
        if chosen:
            part = search_block(docs, chosen, item_type, k)
            found = part if found is None else found.unionByName(part)
    if found is None:
        schema = T.StructType().add("item_id", item_type).add("rank", T.IntegerType())
        return spark.createDataFrame([], schema.add("doc_id", docs.schema["doc_id"].dataType).add("score", T.LongType()))
    return found
