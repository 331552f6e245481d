"""Exact Jaccard join of shingle sets with signature trees.

Two documents link when their sets of five-word shingles have a similarity of 0.8 or more; every document gets
the smallest id it can reach over links. Nothing is approximate: all steps before the exact check keep every link.

1. Equal sets are one class. A class is routed by its prefix: for 0.8 or more, two sets must share one of their
   first n - ceil(0.8 n) + 1 shingles in any common order. The order puts frequent shingles last; how frequent they
   are comes from a table of counts of fixed size, so that passages many documents share rarely route anything.
2. Shingles with the same classes are one bucket (their sets of classes are compared by sums of hashes).
3. Each bucket is a signature tree: leaves hold a few classes, nodes the OR of their token bitmaps, the range of
   their sizes and the most tokens that any of them has beyond its bits. A dual traversal drops node pairs whose
   sizes differ too much or whose greatest possible overlap,

       bits in common + tokens beyond the bits,

   is below what 0.8 asks of their smallest sizes. Leaf pairs that remain are bounded the same way, one by one.
   Only bitmaps travel for this; classes without a partner are done, the others are left in clusters.
4. The clusters of all buckets are joined to components of candidates, in which each class is once. The texts of
   these follow, and a second traversal of signature trees compares what its bounds leave exactly. In both, pairs that are joined already are skipped: only the components matter, so groups of near copies
   cost about one comparison each, and no bucket emits more links than it has classes.
5. Buckets above `bucket_rows` classes are cut into chunks, one tree each, and trees are joined chunk by chunk.
6. Components of the links are found by alternating star contraction.

Sets and classes are held by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventlayers.llm.common import (
    _BASE,
    byte_table,
    chunks,
    finish,
    id_and_text,
    lean_worker,
    materialise,
    powers,
    row_schema,
    text_bytes,
)
from eventlayers.llm.quality import SPACES

WORDS = 5
#: Buckets of the table of counts (a power of two): its size does not depend on the corpus.
COUNT_BITS = 22
SLICES = 64
BUCKET_ROWS = 800
LOT_BYTES = 8 << 20
#: Bytes of texts that a task works on at once.
CHUNK_BYTES = 2 << 20
LEAF, FANOUT = 12, 6
SEED = 0x5851F42D4C957F2D


def required(a, b):
    """The least overlap of sets of sizes a and b with a similarity of 0.8: 9 o >= 4 (a + b)."""
    return -(-4 * (a + b) // 9)


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1


_INVERSE = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    global _INVERSE
    if len(_INVERSE) < n:
        grown = np.full(max(n, 2 * len(_INVERSE), 4096), np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
        grown[0] = 1
        _INVERSE = np.cumprod(grown, dtype=np.uint64)
    return _INVERSE[:n]


def shingles(text: bytes) -> np.ndarray:
    """The sorted hashes of the distinct shingles; fewer words than five are one shingle, none are none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b" ".join(words), np.uint8)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_table(SEED)[data] * powers(len(data)), out=sums[1:])
    gaps = np.flatnonzero(data == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])
    if len(words) < WORDS:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(starts) - WORDS + 1], ends[WORDS - 1 :]
    own = (sums[ends] - sums[starts]) * inverse_powers(len(data))[starts]
    return np.unique(finish(own + (ends - starts).astype(np.uint64)))


def class_key(s: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    mixed = finish(np.array([finish(s ^ np.uint64(SEED)).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64))
    return int(mixed.view(np.int64)[0])


def signed(s: np.ndarray) -> np.ndarray:
    return s.view(np.int64)


# --- tables of counts of fixed size ---------------------------------------------------------


def count_rows(counts: np.ndarray) -> tuple[list[int], list[bytes]]:
    """A task's counts as compressed slices."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return list(range(SLICES)), [squeeze(x.astype(np.uint64).tobytes()) for x in counts.reshape(SLICES, -1)]


def summed_counts(slices: DataFrame, at_once: int = 256) -> np.ndarray:
    """The sums of all tasks' slices, as 8-bit logarithms (0 for none, else 1 + 4 log2): a fixed number of bytes.

    `slices` is read several times and should be a written table. Where a slice has more than `at_once` rows, they are
    dealt to lots of about as many and summed in rounds, so that no task holds the rows of all tasks.
    """

    def total_of(table: pa.Table) -> np.ndarray:
        lean_worker()
        grow = zstandard.ZstdDecompressor().decompress
        total = np.zeros((1 << COUNT_BITS) // SLICES, np.uint64)
        for x in table.column("counts"):
            total += np.frombuffer(grow(x.as_py()), np.uint64)
        return total

    def add_some(table: pa.Table) -> pa.Table:
        data = zstandard.ZstdCompressor(level=1).compress(total_of(table).tobytes())
        return pa.table({"slice": table.column("slice")[:1], "counts": [data]})

    while (rows := slices.count()) > SLICES * at_once:
        lot = F.pmod(F.xxhash64("counts"), F.lit(-(-rows // (SLICES * at_once))))
        some = slices.groupBy("slice", lot.alias("lot")).applyInArrow(add_some, "slice int, counts binary")
        slices = materialise(some, "counts")

    def add(table: pa.Table) -> pa.Table:
        total = total_of(table).astype(np.float64)
        logs = np.where(total > 0, 1 + np.floor(4 * np.log2(np.maximum(total, 1))), 0).clip(0, 255).astype(np.uint8)
        return pa.table({"slice": table.column("slice")[:1], "counts": [logs.tobytes()], "n": [float(total.sum())]})

    summed = slices.groupBy("slice").applyInArrow(add, "slice int, counts binary, n double").collect()
    out = np.zeros((SLICES, (1 << COUNT_BITS) // SLICES), np.uint8)
    total = 0.0
    for r in summed:
        out[r["slice"]] = np.frombuffer(r["counts"], np.uint8)
        total += r["n"]
    mean = total / (1 << COUNT_BITS)
    # Counts within what chance gives a bucket are all alike.
    usual = 1 + np.floor(4 * np.log2(mean + 6 * np.sqrt(mean) + 8))
    return np.where(out > usual, out, (out > 0).astype(np.uint8)).reshape(-1)


def counter() -> np.ndarray:
    return np.zeros(1 << COUNT_BITS, np.uint32)


def count(into: np.ndarray, s: np.ndarray) -> None:
    np.add.at(into, (s >> np.uint64(64 - COUNT_BITS)).astype(np.int64), np.uint32(1))


# --- trees ----------------------------------------------------------------------------------


class Node:
    """`rows` are places of its classes in the order of the leaves."""

    __slots__ = ("bits", "beyond", "children", "high", "low", "rows")

    def __init__(self, rows: slice, bits: np.ndarray, low: int, high: int, beyond: int, children: list[Node]):
        self.rows, self.bits, self.low, self.high, self.beyond, self.children = rows, bits, low, high, beyond, children


def bitmaps(sets: list[np.ndarray], width: int) -> np.ndarray:
    """One row of `width` bits per set."""
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    place = (np.concatenate(sets) >> np.uint64(64 - width.bit_length() + 1)).astype(np.int64)
    flags = np.zeros((len(sets), width), np.uint8)
    flags[np.repeat(np.arange(len(sets)), lengths), place] = 1
    return np.packbits(flags, axis=1).view(np.uint64)


def width_for(sets: list[np.ndarray]) -> int:
    return min(1 << 14, max(256, 1 << (2 * max(map(len, sets)) - 1).bit_length()))


class Tree:
    """Classes in leaf order: similar sizes together, and within them those with the same smallest shingle."""

    def __init__(self, sizes: np.ndarray, first: np.ndarray, bits: np.ndarray):
        self.order = np.lexsort((first, np.floor(np.log(sizes) / np.log(1.25))))
        self.sizes, self.bits = sizes[self.order], bits[self.order]
        self.beyond = self.sizes - np.bitwise_count(self.bits).sum(axis=1)
        n = len(sizes)
        nodes = [self._node(slice(i, min(i + LEAF, n)), []) for i in range(0, n, LEAF)]
        while len(nodes) > 1:
            nodes = [
                self._node(slice(part[0].rows.start, part[-1].rows.stop), part)
                for part in (nodes[i : i + FANOUT] for i in range(0, len(nodes), FANOUT))
            ]
        self.root = nodes[0]

    @classmethod
    def of_sets(cls, sets: list[np.ndarray], width: int) -> Tree:
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        first = np.fromiter((s[0] for s in sets), np.uint64, len(sets))
        return cls(sizes, first, np.concatenate([bitmaps(sets[k : k + 256], width) for k in range(0, len(sets), 256)]))

    def _node(self, rows: slice, children: list[Node]) -> Node:
        bits = np.bitwise_or.reduce([c.bits for c in children] if children else self.bits[rows], axis=0)
        n = self.sizes[rows]
        return Node(rows, bits, int(n.min()), int(n.max()), int(self.beyond[rows].max()), children)


def may_link(a: Node, b: Node) -> bool:
    """Whether any two classes below the nodes can be similar enough."""
    if 5 * a.high < 4 * b.low or 5 * b.high < 4 * a.low:
        return False
    common = int(np.bitwise_count(a.bits & b.bits).sum())
    return common + min(a.beyond, b.beyond) >= required(a.low, b.low)


def join_trees(a: Tree, b: Tree, same, labels: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> list[tuple[int, int]]:
    """Links that join components of `labels`, which holds the present component of each class and is updated; `at_a`
    and `at_b` are the places of the trees' classes in it. A tree is joined with itself if both are the same.
    `same(x, y, least)` decides on two places whose bound reaches `least`."""
    links: list[tuple[int, int]] = []
    mine, theirs = at_a[a.order], at_b[b.order]
    stack = [(a.root, b.root)]
    while stack:
        u, v = stack.pop()
        own, other = labels[mine[u.rows]], labels[theirs[v.rows]]
        if own[0] == other[0] and (own == own[0]).all() and (other == other[0]).all():
            continue
        if not may_link(u, v):
            continue
        if u.children or v.children:
            if u is v:
                stack += [(x, y) for i, x in enumerate(u.children) for y in u.children[i:]]
            elif u.children and (not v.children or u.rows.stop - u.rows.start >= v.rows.stop - v.rows.start):
                stack += [(x, v) for x in u.children]
            else:
                stack += [(u, y) for y in v.children]
            continue
        for i in range(u.rows.start, u.rows.stop):
            js = np.arange(i + 1 if u is v else v.rows.start, v.rows.stop)
            if not len(js):
                continue
            common = np.bitwise_count(a.bits[i] & b.bits[js]).sum(axis=1)
            need = required(a.sizes[i], b.sizes[js])
            fits = (5 * np.minimum(a.sizes[i], b.sizes[js]) >= 4 * np.maximum(a.sizes[i], b.sizes[js])) & (
                common + np.minimum(a.beyond[i], b.beyond[js]) >= need
            )
            for j, least in zip(js[fits].tolist(), need[fits].tolist()):
                x, y = int(mine[i]), int(theirs[j])
                if labels[x] != labels[y] and same(x, y, least):
                    links.append((x, y))
                    labels[labels == labels[y]] = labels[x]
    return links


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def bucket_links(sets: list[np.ndarray], side: np.ndarray) -> list[tuple[int, int]]:
    """Links within one bucket (all of side 0) or between its two chunks; places of the sets."""
    first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(first):
        return []
    width = width_for(sets)
    a = Tree.of_sets([sets[i] for i in first], width)
    b, at_b = (Tree.of_sets([sets[i] for i in second], width), second) if len(second) else (a, first)
    return join_trees(a, b, lambda x, y, least: overlap(sets[x], sets[y]) >= least, np.arange(len(sets)), first, at_b)


def octave(n) -> np.ndarray:
    """The power of two that a size is below or at."""
    return np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)


def octave_width(o: int) -> int:
    """Bits of the bitmaps of an octave: two for each token, within bounds."""
    return min(1 << 15, max(256, 2 << o))


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """A bitmap with fewer bits: neighbouring bits are joined."""
    flags = np.unpackbits(bits.view(np.uint8))
    return np.packbits(flags.reshape(width, -1).any(axis=1)).view(np.uint64)


def bucket_clusters(sizes: np.ndarray, first: np.ndarray, bits: list[np.ndarray], side: np.ndarray) -> list[list[int]]:
    """Places of the classes of a bucket that have partners by their bitmaps, in clusters.

    Sizes that link are at most a quarter apart, so each octave of sizes has its own tree, with bitmaps to measure,
    and takes in the smallest of the next octave.
    """
    out = []
    own = octave(sizes)
    for o in np.unique(own).tolist():
        rows = np.flatnonzero((own == o) | ((own == o + 1) & (4 * sizes <= 5 << o)))
        if len(rows) < 2 or (side.any() and side[rows].all() | ~side[rows].any()):
            continue
        width = octave_width(o)
        maps = np.stack([b if 64 * len(b) == width else folded(b, width) for b in (bits[i] for i in rows)])
        labels = np.arange(len(rows))
        a_rows, b_rows = np.flatnonzero(side[rows] == 0), np.flatnonzero(side[rows] == 1)
        a = Tree(sizes[rows[a_rows]], first[rows[a_rows]], maps[a_rows])
        b = Tree(sizes[rows[b_rows]], first[rows[b_rows]], maps[b_rows]) if len(b_rows) else a
        join_trees(a, b, lambda *_: True, labels, a_rows, b_rows if len(b_rows) else a_rows)
        order = np.argsort(labels, kind="stable")
        cuts = np.flatnonzero(np.diff(labels[order])) + 1
        out += [rows[c].tolist() for c in np.split(order, cuts) if len(c) > 1]
    return out


# --- Spark ----------------------------------------------------------------------------------


def shingle_sets(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """`doc_id, n_shingles, cls` (null for no shingles) of every row, and how frequent hashes of shingles are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        counts, kind = counter(), None
        for batch in batches:
            kind = batch.column(0).type
            sizes, keys = [], []
            for s in map(shingles, text_bytes(batch.column(1))):
                count(counts, s)
                sizes.append(len(s))
                keys.append(class_key(s) if len(s) else None)
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "cls", "slice", "counts"],
            )
        if kind is not None:
            slices, data = count_rows(counts)
            nothing = [pa.nulls(SLICES, kind), pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*nothing, pa.array(slices, pa.int32()), pa.array(data, pa.binary())],
                names=["doc_id", "n_shingles", "cls", "slice", "counts"],
            )

    schema = row_schema(docs, "n_shingles bigint, cls bigint, slice int, counts binary")
    both = materialise(id_and_text(docs).mapInArrow(run, schema), "shingle-classes")
    frequent = summed_counts(both.where(F.col("slice").isNotNull()).select("slice", "counts"))
    return both.where(F.col("slice").isNull()).select("doc_id", "n_shingles", "cls"), frequent


def new_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, int, np.ndarray]]]:
    """Text, class and shingles of the classes that a task has not met before, in lists of a few texts."""
    lean_worker()
    seen: set[int] = set()
    for batch in batches:
        texts = text_bytes(batch.column(0))
        for part in chunks([len(t) for t in texts], CHUNK_BYTES):
            out = []
            for t in texts[part]:
                s = shingles(t)
                if len(s) and (key := class_key(s)) not in seen:
                    seen.add(key)
                    out.append((t, key, s))
            yield out


def prefix_tokens(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """`token, cls`: the routing shingles of each class, at least once."""
    table = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = table.value
        for some in new_classes(batches):
            tokens = []
            for _, _, s in some:
                rank = ranks[(s >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
                tokens.append(s[np.argsort(rank, kind="stable")[: prefix_length(len(s))]])
            if tokens:
                keys = np.repeat(np.array([k for _, k, _ in some], np.int64), [len(t) for t in tokens])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate(tokens))), pa.array(keys)], names=["token", "cls"]
                )

    return id_and_text(docs).select("text").mapInArrow(run, "token bigint, cls bigint")


def shared_buckets(routes: DataFrame) -> DataFrame:
    """`bucket, cls`: the classes that meet, once for all shingles with the same classes."""
    spans = routes.groupBy("token").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).where("low < high")
    met = materialise(routes.join(spans.select("token"), "token", "left_semi").distinct(), "routes")
    mixed = F.xxhash64("cls")
    digest = met.groupBy("token").agg(
        F.count("*").alias("n"), F.min("cls").alias("low"), F.max("cls").alias("high"),
        F.sum(mixed.bitwiseAND(0xFFFFFFFF)).alias("a"), F.sum(F.shiftrightunsigned(mixed, 32)).alias("b"),
    )
    named = digest.select("token", F.xxhash64("n", "low", "high", "a", "b").alias("bucket"))
    return met.join(named, "token").select("bucket", "cls").distinct()


def of_classes(docs: DataFrame, wanted: DataFrame, schema: str, describe) -> DataFrame:
    """A row for each class of `wanted` (column `cls`): its class and what `describe(text, shingles)` makes of it."""
    spark = docs.sparkSession
    names = T.StructType.fromDDL(schema).fieldNames()
    types = to_arrow_schema(T.StructType.fromDDL(schema)).types

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        counts = counter()
        for batch in batches:
            count(counts, batch.column(0).to_numpy().view(np.uint64))
        index, data = count_rows(counts)
        yield pa.RecordBatch.from_arrays([pa.array(index, pa.int32()), pa.array(data, pa.binary())], names=["slice", "counts"])

    # A filter of fixed size: it spares most classes the way where few are wanted; the join decides.
    counted = materialise(wanted.mapInArrow(slices, "slice int, counts binary"), "counts")
    table = spark.sparkContext.broadcast(summed_counts(counted) > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = table.value
        for some in new_classes(batches):
            rows = [(k, *describe(t, s)) for t, k, s in some if asked[(k & (1 << 64) - 1) >> (64 - COUNT_BITS)]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return id_and_text(docs).select("text").mapInArrow(run, schema).dropDuplicates(["cls"])


def signature(_: bytes, s: np.ndarray) -> tuple[int, int, bytes]:
    return len(s), int(s[0].view(np.int64)), bitmaps([s], octave_width(int(octave(len(s)))))[0].tobytes()


def packed_words(text: bytes, _: np.ndarray) -> tuple[bytes]:
    """The words of a text, compressed: a third of what the hashes of its shingles take."""
    return (zstandard.ZstdCompressor(level=3).compress(b" ".join(text.lower().split())),)


def by_cell(table: pa.Table) -> Iterator[np.ndarray]:
    """Row numbers of each cell."""
    cell = table.column("cell").to_numpy()
    order = np.lexsort((table.column("cls").to_numpy(), cell))
    yield from np.split(order, np.flatnonzero(np.diff(cell[order])) + 1)


def grid(buckets: DataFrame, bucket_rows: int) -> DataFrame:
    """`cell, cls, side`: a bucket (`bucket, cls`) as pairs of chunks of at most about `bucket_rows` classes."""
    sizes = buckets.groupBy("bucket").agg(F.ceil(F.count("*") / bucket_rows).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("cls", F.lit(3)), F.col("chunks")).cast("int")
    # A class of chunk c meets the chunks k of its bucket, once for each.
    return (
        buckets.join(sizes, "bucket").withColumn("c", chunk)
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            F.xxhash64("bucket", F.least("c", "k"), F.greatest("c", "k")).alias("cell"), "cls",
            (F.col("c") > F.col("k")).cast("int").alias("side"),
        )
    )


def candidate_links(docs: DataFrame, buckets: DataFrame, bucket_rows: int, lot_bytes: int) -> DataFrame:
    """`a, b`: links that join all classes of a bucket between which the bitmaps leave a path."""
    cells = grid(buckets, bucket_rows)
    lots = max(1, -(-cells.count() * 512 // lot_bytes))
    marks = of_classes(docs, buckets.select("cls").distinct(), "cls bigint, size bigint, first bigint, bits binary", signature)
    rows = cells.join(marks, "cls").withColumn("lot", F.pmod("cell", F.lit(lots)))

    def run(table: pa.Table) -> pa.Table:
        lean_worker()
        size, side = table.column("size").to_numpy(), table.column("side").to_numpy()
        cls, first = table.column("cls").to_numpy(), table.column("first").to_numpy().view(np.uint64)
        bits = table.column("bits").combine_chunks()
        a: list[int] = []
        b: list[int] = []
        for rows in by_cell(table):
            maps = [np.frombuffer(bits[int(i)].as_buffer(), np.uint64) for i in rows]
            for members in bucket_clusters(size[rows], first[rows], maps, side[rows]):
                keys = cls[rows[members]].tolist()
                a += keys[1:]
                b += keys[:1] * (len(keys) - 1)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("lot").applyInArrow(run, "a bigint, b bigint")


def class_links(docs: DataFrame, buckets: DataFrame, bucket_rows: int, lot_bytes: int) -> DataFrame:
    """`a, b`: links between classes, enough of them to join what all links join."""
    buckets = materialise(buckets, "buckets")
    paths = components(candidate_links(docs, buckets, bucket_rows, lot_bytes))
    # A class is in one candidate component, so its text goes one way only.
    members = paths.select(F.col("root").alias("bucket"), F.col("node").alias("cls"))
    roots = paths.select(F.col("root").alias("bucket"), F.col("root").alias("cls")).distinct()
    cells = materialise(grid(members.unionByName(roots), bucket_rows), "cells")
    lots = max(1, -(-cells.count() * 4096 // lot_bytes))
    texts = of_classes(docs, cells.select("cls").distinct(), "cls bigint, words binary", packed_words)
    rows = cells.join(texts, "cls").select("cell", "cls", "side", "words", F.pmod("cell", F.lit(lots)).alias("lot"))

    def run(table: pa.Table) -> pa.Table:
        lean_worker()
        cls, side = table.column("cls").to_numpy(), table.column("side").to_numpy()
        words = table.column("words").combine_chunks()
        grow = zstandard.ZstdDecompressor().decompress
        a: list[int] = []
        b: list[int] = []
        for rows in by_cell(table):
            sets = [shingles(grow(words[int(i)].as_py())) for i in rows]
            for x, y in bucket_links(sets, side[rows]):
                a.append(int(cls[rows[x]]))
                b.append(int(cls[rows[y]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("lot").applyInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """`node, root` for every node of the links `a, b`: the smallest node it is connected with.

    Alternating large and small stars: each step moves edges to smaller neighbours until all point to their root.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges, before = materialise(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(a.alias("node"), b.alias("root"))
        before = state
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(root, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        edges = materialise(small.unionByName(root.select("a", F.col("m").alias("b"))).distinct(), "links")


def class_roots(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, lot_bytes: int = LOT_BYTES) -> tuple[DataFrame, DataFrame]:
    """The rows (`doc_id, n_shingles, cls`), and of each class its smallest id and the root of its component."""
    rows, frequent = shingle_sets(docs)
    routes = materialise(prefix_tokens(docs, frequent), "prefixes")
    roots = components(class_links(docs, shared_buckets(routes), bucket_rows, lot_bytes))
    classes = rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("doc_id").alias("low"))
    classes = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    return rows, materialise(classes.select("cls", "low", F.coalesce("root", "cls").alias("root")), "class-roots")


def similar_documents(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, lot_bytes: int = LOT_BYTES) -> DataFrame:
    """`doc_id, n_shingles, component_id` of every row.

    A null or empty text, or one without words, has no shingles and is linked with nothing: its component is its own
    id. Rows that repeat a text or an id are rows of the result each; a null id is never the smallest unless
    the component has no other, then the component is null. An empty table gives no rows.
    """
    rows, classes = class_roots(docs, bucket_rows, lot_bytes)
    least = classes.groupBy("root").agg(F.min("low").alias("component"))
    of_class = classes.join(least, "root").select("cls", "component")
    own = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return rows.join(of_class, "cls", "left").select("doc_id", "n_shingles", own.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without near duplicates: of each component one row stays, one with its smallest id.

    Where several rows of the component have that id, one of a single text of theirs stays. Rows without words are
    linked with nothing and all stay.
    """
    names = docs.columns
    inner = docs.select(*(docs[c].alias(f"_c{i}") for i, c in enumerate(names)))
    key, at = f"_c{names.index('doc_id')}", names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        for batch in batches:
            texts = text_bytes(batch.column(at))
            for part in chunks([len(t) for t in texts], CHUNK_BYTES):
                keys = [class_key(s) if len(s) else None for s in map(shingles, texts[part])]
                yield batch[part].append_column("cls", pa.array(keys, pa.int64()))

    _, classes = class_roots(docs)
    first = F.min(F.struct(F.col("low").isNull(), F.col("low").alias("low"), F.col("cls").alias("cls")))
    chosen = classes.groupBy("root").agg(first.alias("x")).select("x.cls", "x.low")
    # No words, no class; these rows need no key.
    wordless = F.coalesce(F.btrim(F.col(f"_c{at}"), F.lit(SPACES)), F.lit("")) == ""
    schema = T.StructType([*inner.schema.fields, T.StructField("cls", T.LongType())])
    keyed = inner.where(~wordless).mapInArrow(run, schema)
    kept = keyed.join(chosen, "cls").where(F.col(key).eqNullSafe(F.col("low"))).dropDuplicates(["cls"])
    both = kept.select(*inner.columns).unionByName(inner.where(wordless))
    return both.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(names)))
