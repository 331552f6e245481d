"""Near duplicates by SimHash fingerprints, found through a segment-popcount embedding.

A fingerprint of 64 bits is mapped to the bit counts of its 16 segments of 4 bits. Changing one bit moves one count by
one, so the Manhattan distance of two such vectors never exceeds the Hamming distance of the fingerprints, and
fingerprints within `MOST_BITS` = 2 bits have vectors within 2. Such vectors meet in a cell of the integer grid that
is within 1 of both; so each distinct fingerprint goes to its own cell and the next one along each axis, and the range
join is an equality of cells:

1. Rows with one fingerprint are one class, so copies cost nothing further.
2. A class is sent to at most 33 cells; a task reads its cells in order and compares what meets there exactly.
3. A cell above `cell_rows` classes compares nothing. Its classes are embedded once more with 64 segments of one bit,
   where the Manhattan distance is the Hamming distance: such a cell holds at most 65 fingerprints, all of which
   link, and each is linked with the smallest of them.
4. Components of the links are found by alternating star contraction.

So a fingerprint makes at most 33 + 65 rows, however many of them are alike, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlayers.llm.common import attach, chunks, id_and_text, materialise, row_schema, text_bytes
from eventlayers.llm.sigtree import components

BITS, SEGMENT = 64, 4
MOST_BITS = 2
WORDS, SEED = 3, 42
#: Most classes of a cell that are compared with each other; beyond, the finer embedding takes over.
CELL_ROWS = 128
CHUNK_BYTES = 1 << 20
_BLOCK = 1 << 16


def shingle_hashes(text: bytes) -> np.ndarray:
    """XXH64 of each shingle of three lower-cased words, repeats included; of all words where there are fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = max(1, len(words) - WORDS + 1)
    spans = zip(starts[:n].tolist(), ends[-n:].tolist())
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as a signed number; zero without hashes."""
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), _BLOCK):
        some = hashes[k : k + _BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """`doc_id, fp` of every row; the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for part in chunks([len(t) for t in texts], CHUNK_BYTES):
                found = [fingerprint(shingle_hashes(t)) for t in texts[part]]
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return id_and_text(docs).mapInArrow(run, row_schema(docs, "fp bigint"))


def _bits(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def grid_cells(classes: DataFrame) -> DataFrame:
    """`cell, fp`: the cells of the grid within one step of each fingerprint's counts, three bits for each count."""
    ones = {
        3 * k: F.bit_count(F.col("fp").bitwiseAND(_bits(15 << SEGMENT * k))).cast("long") for k in range(BITS // SEGMENT)
    }
    own = sum((F.shiftleft(c, k) for k, c in ones.items()), F.lit(0).cast("long"))
    rows = classes.select("fp", own.alias("own"))
    at, steps = F.col("own"), []
    for k in ones:
        count, one = F.shiftright(at, k).bitwiseAND(F.lit(7)), F.lit(1 << k)
        steps += [F.when(count < SEGMENT, at + one), F.when(count > 0, at - one)]
    return rows.select(F.explode(F.array_compact(F.array(at, *steps))).alias("cell"), "fp")


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links join what the links before them have not."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    keep = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            keep[k] = True
    return keep


def links_in_cells(cell: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of one cell at 2 or fewer bits, enough to join what all of them join; rows sorted by cell."""
    a, b = [], []
    rows = np.arange(len(cell))
    for step in range(1, len(cell)):
        rows = rows[: np.searchsorted(rows, len(cell) - step)]
        rows = rows[cell[rows] == cell[rows + step]]
        if not len(rows):
            break
        near = rows[np.bitwise_count((fp[rows] ^ fp[rows + step]).view(np.uint64)) <= MOST_BITS]
        a.append(near)
        b.append(near + step)
    if not a:
        return fp[:0], fp[:0]
    a, b = np.concatenate(a), np.concatenate(b)
    keep = spanning(a, b)
    return fp[a[keep]], fp[b[keep]]


def cell_links(classes: DataFrame, cell_rows: int) -> DataFrame:
    """`a, b`: links within the cells; and with `b` null, each class `a` of a cell that holds too many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, np.int64)
        cells, fps, crowded = empty, empty, None

        def settle(cells: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            _, at, n = np.unique(cells, return_inverse=True, return_counts=True)
            many = (n > cell_rows)[at] | (cells == crowded if crowded is not None else False)
            x, y = links_in_cells(cells[~many], fps[~many])
            only = np.unique(fps[many])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([x, only])), pa.array([*y.tolist(), *[None] * len(only)], pa.int64())], names=["a", "b"]
            )

        for batch in batches:
            cells = np.concatenate([cells, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy()])
            if not len(cells):
                continue
            # The last cell may go on in the next batch; a crowded one needs no more than its key.
            cut = int(np.searchsorted(cells, cells[-1]))
            if cut:
                yield settle(cells[:cut], fps[:cut])
                cells, fps = cells[cut:], fps[cut:]
            if len(cells) > cell_rows or cells[0] == crowded:
                yield settle(cells, fps)
                crowded = int(cells[0])
                cells, fps = empty, empty
        if len(cells):
            yield settle(cells, fps)

    rows = grid_cells(classes).repartition("cell").sortWithinPartitions("cell", "fp")
    return rows.mapInArrow(run, "a bigint, b bigint")


def bit_links(classes: DataFrame) -> DataFrame:
    """`a, b`: links of the embedding with one bit a segment, whose cells hold fingerprints that all link, 65 at most."""
    fp = F.col("fp")
    cells = classes.select(fp, F.explode(F.array(fp, *(fp.bitwiseXOR(_bits(1 << k)) for k in range(BITS)))).alias("cell"))
    met = cells.groupBy("cell").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return met.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a <> b").distinct()


def fingerprint_links(classes: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """`a, b`: links between the distinct fingerprints `fp`, enough of them to join what all links join."""
    found = materialise(cell_links(classes.select("fp"), cell_rows), "cell-links")
    crowded = found.where(F.col("b").isNull()).select(F.col("a").alias("fp")).distinct()
    return found.where(F.col("b").isNotNull()).unionByName(bit_links(crowded))


def near_duplicates(docs: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """`doc_id, fingerprint, component_id` of every row.

    A null or empty text, or one without words, has fingerprint zero and is linked like any other. Rows that repeat a
    text or an id are rows of the result each; a null id is the smallest of a component only where the component
    has no other, then `component_id` is null. An empty table gives no rows. Other columns are left behind.
    """
    rows = materialise(fingerprints(docs), "fingerprints")
    classes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "fingerprint-classes")
    roots = components(fingerprint_links(classes, cell_rows))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = materialise(named, "fingerprint-roots")
    # A class alone is its own component; the others ask their root.
    joined = named.where(F.col("fp") != F.col("root")).select("root").distinct()
    least = named.join(joined, "root", "left_semi").groupBy("root").agg(F.min("low").alias("least"))
    of_class = named.join(least, "root", "left").select("fp", "n", F.coalesce("least", "low").alias("component_id"))
    of_class = materialise(of_class, "fingerprint-components")
    whole = attach(rows, of_class, "fp", "n")
    return whole.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
