"""Topic offsets: what is missing, how far a partition is whole, and repeats of any age kept out.

Offsets are taken in stripes, runs of consecutive numbers of a fixed length. A stripe is the largest group that any task
gets, whatever the length of the topic, and one topic partition is as many groups as it has stripes. Messages
without an offset are not messages of a topic; they are left out of gaps and never taken for repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PLACE = ("topic", "partition")
# Offsets of a stripe: for gaps a million narrow rows, for repeats fewer, as whole messages go to a task.
GAP_STRIPE = 1 << 20
STATE_STRIPE = 1 << 16

_STRIPE = "_stripe"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _striped(messages: DataFrame, stripe: int) -> DataFrame:
    return messages.withColumn(_STRIPE, F.floor(F.col("offset") / stripe).cast("bigint"))


def offset_gaps(messages: DataFrame, stripe: int = GAP_STRIPE) -> DataFrame:
    """Runs of offsets that no message has, between the first and the last of each topic partition.

    `topic, partition, first_missing, last_missing`. Gaps within a stripe are found in the stripe; those that reach over
    the ends of stripes by a second look at one row (first and last offset) for each stripe. Repeats change nothing.
    """
    key = [*PLACE, _STRIPE]
    seen = _striped(messages.filter("offset IS NOT NULL").select(*PLACE, "offset"), stripe).distinct().repartition(*key)
    before = F.lag("offset").over(Window.partitionBy(*key).orderBy("offset"))
    within = seen.withColumn("before", before)
    ends = seen.groupBy(*key).agg(F.min("offset").alias("offset"), F.max("offset").alias("last"))
    across = ends.withColumn("before", F.lag("last").over(Window.partitionBy(*PLACE).orderBy(_STRIPE)))
    steps = within.select(*PLACE, "before", "offset").unionByName(across.select(*PLACE, "before", "offset"))
    return steps.filter(F.col("offset") - F.col("before") > 1).select(
        *PLACE, (F.col("before") + 1).alias("first_missing"), (F.col("offset") - 1).alias("last_missing")
    )


def contiguous_offsets(messages: DataFrame, stripe: int = GAP_STRIPE) -> DataFrame:
    """How far each topic partition is whole: a consumer that goes on at `contiguous_until` misses nothing.

    `topic, partition, first_offset, contiguous_until` (the first missing offset), `next_offset` (after the last one seen),
    `gaps, missing_offsets`.
    """
    gaps = offset_gaps(messages, stripe).groupBy(*PLACE).agg(
        F.min("first_missing").alias("until"),
        F.count("*").alias("gaps"),
        F.sum(F.col("last_missing") - F.col("first_missing") + 1).alias("missing"),
    )
    ends = messages.filter("offset IS NOT NULL").groupBy(*PLACE).agg(
        F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("next_offset")
    )
    return ends.join(gaps, list(PLACE), "left").select(
        *PLACE, "first_offset", F.coalesce("until", "next_offset").alias("contiguous_until"), "next_offset",
        F.coalesce("gaps", F.lit(0)).alias("gaps"), F.coalesce("missing", F.lit(0)).alias("missing_offsets"),
    )


def held(starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which offsets lie in one of the runs [start, end], which are in order and apart."""
    if not len(starts):
        return np.zeros(len(offsets), dtype=bool)
    run = np.searchsorted(starts, offsets, side="right") - 1
    return (run >= 0) & (offsets <= ends[np.maximum(run, 0)])


def with_offsets(starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs with more offsets, none of them held so far; runs that touch become one."""
    order = np.argsort(first := np.concatenate([starts, offsets]), kind="stable")
    first, last = first[order], np.concatenate([ends, offsets])[order]
    apart = first[1:] > last[:-1] + 1
    return first[np.concatenate([[True], apart])], last[np.concatenate([apart, [True]])]


class _Runs(StatefulProcessor):
    """Passes on the rows whose offset is in no run of the stripe, and keeps the runs."""

    def __init__(self, columns: list[str]) -> None:
        self._columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._runs = handle.getValueState("runs", "starts array<bigint>, ends array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = self._runs.get() if self._runs.exists() else ((), ())
        starts, ends = (np.asarray(k, dtype=np.int64) for k in kept)
        for part in rows:
            offsets = part["offset"].to_numpy(dtype=np.int64)
            fresh = ~part["offset"].duplicated().to_numpy() & ~held(starts, ends, offsets)
            if fresh.any():
                starts, ends = with_offsets(starts, ends, offsets[fresh])
                # The columns of the key come beside the rows.
                yield part[fresh].assign(**dict(zip(PLACE, key)))[self._columns]
        self._runs.update((starts.tolist(), ends.tolist()))

    def close(self) -> None:
        pass


def dedupe_by_runs(rows: DataFrame, stripe: int = STATE_STRIPE) -> DataFrame:
    """One row per (topic, partition, offset) of a stream, however late a repeat comes.

    The state is exact and never expires. It holds runs of offsets, not offsets: a row for each stripe with one run, and
    one more for each gap that is still open; runs that meet become one. Rows without an offset all pass. Uses the
    RocksDB state store, which this sets for the session; keep rows narrow, as they pass through Python.
    """
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    placed = rows.filter("offset IS NOT NULL")
    once = _striped(placed, stripe).groupBy(*PLACE, _STRIPE).transformWithStateInPandas(
        _Runs(rows.columns), T.StructType(rows.schema.fields), outputMode="Append", timeMode="None"
    )
    return once.unionByName(rows.filter("offset IS NULL"))
