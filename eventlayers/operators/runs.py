"""Run history, reduced from an append-only log of run states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlayers.functions import truncate_error
from eventlayers.schemas import RUN_COUNTERS

# Fixed values.
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
LATEST_LIMIT = 5


def run_history(log: DataFrame) -> DataFrame:
    """One row per run: last status and counters, start, end and duration.

    An open run has no end; a failed one keeps zero counters.
    """
    ended = F.when(F.col("status") != RUNNING, F.col("at"))
    last = F.max_by(F.struct("status", "error_message", *RUN_COUNTERS), F.col("seq"))
    runs = log.groupBy("run_id").agg(
        last.alias("r"),
        F.min("at").alias("started_at"),
        F.max(ended).alias("finished_at"),
    )
    micros = F.unix_micros("finished_at") - F.unix_micros("started_at")
    return runs.select(
        "run_id",
        "r.status",
        *(F.coalesce(f"r.{c}", F.lit(0)).alias(c) for c in RUN_COUNTERS),
        truncate_error(F.col("r.error_message")).alias("error_message"),
        "started_at",
        "finished_at",
        (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(10,3)").alias("duration_seconds"),
    )


def with_totals(runs: DataFrame) -> DataFrame:
    """Gold and loaded rows over both marts."""
    return runs.withColumns(
        {
            "gold_count": F.col("gold_page_views_count") + F.col("gold_product_events_count"),
            "loaded_count": F.col("loaded_page_views_count") + F.col("loaded_product_events_count"),
        }
    )


def latest_runs(runs: DataFrame, limit: int = LATEST_LIMIT) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(limit)
