"""Spelling variants of words, found by Bloom-guided neighbourhoods.

Two words are near if they differ by one inserted, deleted or replaced letter. Each word of the vocabulary generates
the words that one deleted letter or one larger letter in a place makes of it, which reaches every near pair once: the
inserted letter is the deletion seen from the other side, the smaller letter the replacement. These edits are not sent
anywhere; their hashes are probed against Bloom filters of the vocabulary, one for each length, in blocks of one
64-bit word, so that a probe reads one place. Only the few positives become rows, and an exact join with the
vocabulary removes the false ones among them.

The filters are built by an aggregation and broadcast. All of them together take at most `FILTER_BYTES`: where the
vocabulary outgrows that, bits a word become fewer and more false positives reach the join, which stays exact.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlayers.llm.common import byte_table, finish, id_and_text, materialise, text_bytes

# Letters that make a run, one occurrence in so many loses a letter, and bounds on words and forms.
RUN = re.compile("[a-zA-ZÀ-ÿ]+")
MUTATED = 199
LETTERS, OCCURRENCES, TIMES = 6, 5, 5

BLOCK_BITS = 64
WORD_BITS, PROBES = 16, 4
FILTER_BYTES = 64 << 20
#: Blocks of a filter that one group puts together, and words that one task probes.
SLICE_BLOCKS, TASK_WORDS = 1 << 17, 20_000
#: Distinct words that a task adds up before it hands them on, and edits that are probed at once.
HELD_WORDS, PROBED = 200_000, 1 << 18
_SEED = 0x5851F42D4C957F2D
_BASE = np.uint64(0x2545F4914F6CDD1D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def words_of(doc_id, text: str) -> Iterator[tuple[str, int]]:
    """The words of a text of at least six letters with their occurrences; some are mutated, always alike in one document.

    A word can come more than once. A null id counts as the empty text.
    """
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in Counter(RUN.findall(text)).items():
        if len(word) < LETTERS:
            continue
        h = zlib.crc32(word.encode(), start)
        if h % MUTATED == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < LETTERS:
                continue
        yield word, n


def vocabulary(docs: DataFrame, least: int = OCCURRENCES) -> DataFrame:
    """`word, n` of all words with at least so many occurrences over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            texts = text_bytes(batch.column(1))
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                for word, n in words_of(doc_id, text.lower().decode("utf-8", "replace")):
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD_WORDS:
                    yield rows()
                    held = {}
        yield rows()

    counts = id_and_text(docs).mapInArrow(run, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --- Edits and filters ----------------------------------------------------------------------


def letters_matrix(words: list[str]) -> np.ndarray:
    """Words of one length as rows of bytes; every letter of a run is one byte of Latin-1."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def weights(length: int) -> np.ndarray:
    grown = np.full(length + 1, _BASE, np.uint64)
    grown[0] = 1
    return np.cumprod(grown, dtype=np.uint64)


def word_sums(matrix: np.ndarray) -> np.ndarray:
    """Sum of letter marks times powers by place: the part of a word's hash that an edit changes locally."""
    return (byte_table(_SEED)[matrix] * weights(matrix.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)


def places(sums: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and mask of each hash in a filter of so many blocks."""
    h = finish(sums.copy())
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    mask = np.zeros(len(h), np.uint64)
    for k in range(PROBES):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return block.astype(np.int64), mask


def probe(sums: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    at, mask = places(sums, len(blocks))
    return (blocks[at] & mask) == mask


def deletions(matrix: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """For each place: the rows that lose a letter there, the place, and the hash sums of what is left.

    Of equal neighbours only the first is left out, so no deletion is given twice.
    """
    power, mark = weights(matrix.shape[1]), byte_table(_SEED)
    after = word_sums(matrix)
    before = np.zeros(len(matrix), np.uint64)
    for i in range(matrix.shape[1]):
        own = mark[matrix[:, i]] * power[i]
        after = after - own
        rows = np.arange(len(matrix)) if i == 0 else np.flatnonzero(matrix[:, i] != matrix[:, i - 1])
        if len(rows):
            yield rows, i, (before + after * _INVERSE)[rows]
        before = before + own


def replacements(matrix: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """For each place: rows, the place, the larger letters put there, and hash sums."""
    power, mark, sums = weights(matrix.shape[1]), byte_table(_SEED), word_sums(matrix)
    for i in range(matrix.shape[1]):
        rows, letter = np.nonzero(alphabet[None, :] > matrix[:, i : i + 1])
        if len(rows):
            new = alphabet[letter]
            yield rows, i, new, sums[rows] + (mark[new] - mark[matrix[rows, i]]) * power[i]


def edited(words: list[str], filters: dict[int, np.ndarray], alphabet: np.ndarray) -> tuple[list[int], list[str]]:
    """Row numbers and edits, of words of one length, that the filters of the vocabulary let through."""
    rows_out: list[int] = []
    edits: list[str] = []
    length = len(words[0])
    matrix = letters_matrix(words)
    if length - 1 in filters:
        for rows, i, sums in deletions(matrix):
            for r in rows[probe(sums, filters[length - 1])].tolist():
                rows_out.append(r)
                edits.append(words[r][:i] + words[r][i + 1 :])
    if length in filters:
        for rows, i, new, sums in replacements(matrix, alphabet):
            hit = probe(sums, filters[length])
            for r, c in zip(rows[hit].tolist(), new[hit].tolist()):
                rows_out.append(r)
                edits.append(words[r][:i] + chr(c) + words[r][i + 1 :])
    return rows_out, edits


def by_length(words: list[str], alphabet_size: int) -> Iterator[np.ndarray]:
    """Row numbers of words of one length, few enough that the edits of a place fit in one probe."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    step = max(1, PROBED // max(1, alphabet_size))
    for same in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        for k in range(0, len(same), step):
            yield same[k : k + step]


def bloom_filters(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """The filter of each length of the vocabulary, `filter_bytes` at most in all (a block for each length at least),
    and the letters that occur, of which there are at most 256."""
    per_length = words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()
    most = 8 * filter_bytes // BLOCK_BITS
    wanted = {r["length"]: -(-r["n"] * WORD_BITS // BLOCK_BITS) for r in per_length}
    share = min(1.0, most / max(1, sum(wanted.values())))
    blocks = {length: max(1, int(n * share)) for length, n in wanted.items()}

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column(0).to_pylist()
            seen = set().union(*some) if some else set()
            at, masks, lengths = [np.zeros(len(seen), np.int64)], [np.array([ord(c) for c in seen], np.uint64)], [np.full(len(seen), -1)]
            for rows in by_length(some, 1):
                matrix = letters_matrix([some[r] for r in rows])
                block, mask = places(word_sums(matrix), blocks[matrix.shape[1]])
                at.append(block)
                masks.append(mask)
                lengths.append(np.full(len(rows), matrix.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(lengths), pa.int32()), pa.array(np.concatenate(at)), pa.array(np.concatenate(masks).view(np.int64))],
                names=["length", "at", "mask"],
            )

    # The letters that occur come along as masks of length -1, one row each.
    marks = words.select("word").mapInArrow(mark, "length int, at bigint, mask bigint")
    marks = materialise(
        marks.withColumn("at", F.when(F.col("length") < 0, F.col("mask")).otherwise(F.col("at")))
        .groupBy("length", "at").agg(F.bit_or("mask").alias("mask")),
        "bloom-blocks",
    )
    letters = sorted(r["mask"] for r in marks.where("length = -1").select("mask").collect())

    def put_together(table: pa.Table) -> pa.Table:
        length, part = table.column("length")[0].as_py(), table.column("part")[0].as_py()
        size = min(SLICE_BLOCKS, blocks[length] - part * SLICE_BLOCKS)
        out = np.zeros(size, np.int64)
        out[table.column("at").to_numpy() - part * SLICE_BLOCKS] = table.column("mask").to_numpy()
        return pa.table({"length": pa.array([length], pa.int32()), "part": pa.array([part], pa.int64()), "blocks": [out.tobytes()]})

    slices = (
        marks.where("length >= 0").withColumn("part", F.floor(F.col("at") / SLICE_BLOCKS)).groupBy("length", "part")
        .applyInArrow(put_together, "length int, part bigint, blocks binary").toArrow()
    )
    filters = {length: np.zeros(n, np.uint64) for length, n in blocks.items()}
    for row in slices.to_pylist():
        data = np.frombuffer(row["blocks"], np.uint64)
        first = row["part"] * SLICE_BLOCKS
        filters[row["length"]][first : first + len(data)] = data
    return filters, np.array(letters, np.uint8)


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """`a, n_a, b, n_b`: every near pair of the vocabulary `word, n`, once."""
    filters, alphabet = bloom_filters(words, filter_bytes)
    shared = words.sparkSession.sparkContext.broadcast((filters, alphabet))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, alphabet = shared.value
        for batch in batches:
            some = batch.column(0).to_pylist()
            for rows in by_length(some, len(alphabet)):
                at, edits = edited([some[r] for r in rows], filters, alphabet)
                own = batch.take(pa.array(rows[at]))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(edits, pa.string())], names=["a", "n_a", "b"])

    tasks = max(1, -(-words.count() // TASK_WORDS))
    positives = words.repartition(tasks, "word").mapInArrow(run, "a string, n_a bigint, b string")
    return positives.join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b").select("a", "n_a", "b", "n_b")


def roots(forms: DataFrame) -> DataFrame:
    """`word, root` of the words that have a form: the last of the chain of forms.

    Each step has at least five times the occurrences of the one before, so a chain has at most 27 steps, and as
    every round doubles what is followed, five rounds end it.
    """
    links = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialise(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "forms")
        links = step.select("word", "root")
        if step.where(F.col("next").isNotNull()).isEmpty():
            return links


def spelling_variants(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """`word, form, root, n, n_near, form_n` of every word of at least six letters and five occurrences.

    Words are the runs of letters of all whole texts, lower-cased in A-Z, some with one letter taken out as the
    contract says. `form` is the near word that occurs most (ties: the smallest), if at least five times as often,
    else null; `root` is the last of the chain of forms, the word itself without one. Null or empty texts have no
    words; rows that repeat a text or an id count as rows each; an empty table gives no rows. Other columns are
    left behind.
    """
    words = materialise(vocabulary(docs), "vocabulary")
    pairs = near_pairs(words, filter_bytes)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )).alias("p")).select("p.*")
    most = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), most.alias("best"))
    formed = F.when(-F.col("best.minus_n") >= TIMES * F.col("n"), F.col("best.near"))
    found = materialise(
        words.join(best, "word", "left").select(
            "word", formed.alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed.isNotNull(), -F.col("best.minus_n")).alias("form_n"),
        ),
        "word-forms",
    )
    last = roots(found.where(F.col("form").isNotNull()))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
