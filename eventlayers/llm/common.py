"""Small helpers the text operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlayers.session import scratch_dir

WHITE = "[\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only `doc_id` and `text` (null becomes empty); other columns, whatever their names, are left behind."""
    return docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(folds)


def id_field(docs: DataFrame) -> T.StructField:
    return T.StructField("doc_id", docs.schema["doc_id"].dataType)


def row_schema(docs: DataFrame, rest: str) -> T.StructType:
    """`doc_id` as the input has it, then the columns of the DDL string `rest`."""
    return T.StructType([id_field(docs), *T.StructType.fromDDL(rest).fields])


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(frame: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors.

    Nothing reads the shuffles of the write again, so their files go with it and not when the driver collects garbage.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, name)
    schema = frame.schema
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        frame.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(schema).parquet(path)


def _give_back(phase: str, info: dict) -> None:
    if phase == "stop" and info["generation"] == 2:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


#: What operators keep of a task for the next ones of the same Python worker.
KEPT: dict = {}


def lean_worker() -> None:
    """What this Python worker frees goes back to the machine whenever it collects garbage, as it does after each task.

    Workers live on between tasks, and idle ones would keep the pages of the largest group they have had. What tasks of
    other operators have kept goes too: a worker of a pipeline would carry it through all stages.
    """
    KEPT.clear()
    if _give_back not in gc.callbacks:
        gc.callbacks.append(_give_back)


#: Keys with at least one in so many of all rows are hot; there are never more of them than this.
HOT_KEYS = 10_000


def attach(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """The columns of `table`, which has each key of `rows` once, at every row; `weight` is the key's number of rows.

    Hot keys, of which there are at most `HOT_KEYS`, are joined by broadcast, so that no task gets all rows of one;
    the others by shuffle. `table` is read several times and should be a written one. `weight` is dropped.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT_KEYS >= total
    few = table.where(hot).drop(weight).select(F.col(key).alias("_key"), *(c for c in table.columns if c not in (key, weight)))
    rest = table.where(~hot).drop(weight)
    near = rows.join(F.broadcast(few), F.col(key) == F.col("_key")).drop("_key")
    far = rows.join(F.broadcast(few.select("_key")), F.col(key) == F.col("_key"), "left_anti")
    return near.unionByName(far.join(rest, key))


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column, nulls as empty."""
    if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [x or b"" for x in column.to_pylist()]


def chunks(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices over consecutive items whose sizes add up to at most `most`; a larger item is alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def sum_by(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of `values` with the given lengths, zero for empty runs."""
    ends = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    at = np.concatenate([[0], np.cumsum(counts)])
    return ends[at[1:]] - ends[at[:-1]]


def hash_words(words: list[bytes], seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    if not words:
        return np.zeros(0, np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64)
    return finish(poly_sums(data, lengths, seed) + lengths.astype(np.uint64))


_POWERS = np.ones(1, np.uint64)
_BASE = np.uint64(0x100000001B3 * 0x9E3779B1 % (1 << 64) | 1)


def powers(n: int) -> np.ndarray:
    """Powers of the odd base of the rolling hash, modulo 2**64; grows as texts need it."""
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 2 * len(_POWERS), 4096), _BASE, np.uint64)
        grown[0] = 1
        _POWERS = np.cumprod(grown, dtype=np.uint64)
    return _POWERS[:n]


def poly_sums(data: np.ndarray, lengths: np.ndarray, seed: int) -> np.ndarray:
    """For each run of bytes, the sum of byte mixes times powers by place in the run."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    terms = mix_bytes(data, seed) * powers(int(lengths.max(initial=0)) + 1)[place]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    return total[ends] - total[starts]


def mix_bytes(data: np.ndarray, seed: int) -> np.ndarray:
    return byte_table(seed)[data.astype(np.uint8)]


_TABLES: dict[int, np.ndarray] = {}


def byte_table(seed: int) -> np.ndarray:
    if seed not in _TABLES:
        _TABLES[seed] = finish((np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(seed))
    return _TABLES[seed]


def finish(x: np.ndarray) -> np.ndarray:
    """The last mixing steps of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordTable:
    """Rows of numbers per distinct word, computed once and kept by a worker while they are few enough."""

    def __init__(self, compute, most: int = 250_000):
        self.compute, self.most = compute, most
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.rows: np.ndarray | None = None

    def ids(self, texts: list[list[bytes]]) -> np.ndarray:
        """The row of each word of the texts, one after the other; valid until the next call."""
        if len(self.index) > self.most:
            self._clear()
        known = len(self.index)
        index = self.index
        out = np.fromiter((index.setdefault(w, len(index)) for t in texts for w in t), np.int64)
        if len(index) > known or self.rows is None:
            new = self.compute(list(islice(index, known, None)))
            self.rows = new if self.rows is None else np.concatenate([self.rows, new])
        return out
