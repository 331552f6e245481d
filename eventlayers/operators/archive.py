"""What to move out of the active layers, what became of it, and what may be deleted."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlayers.operators import ledger

LAYERS = ("bronze", "silver", "gold_page_views", "gold_product_events")


def default_routes(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, layer) -> (source, archive), one row per layer."""
    rows = [(ledger.DATASET, n, f"{root}/{n}", f"{root}/{n}-archive") for n in LAYERS]
    return spark.createDataFrame(rows, "dataset string, layer string, source string, archive string")


def archive_plan(tasks: DataFrame, routes: DataFrame, limit: int | None = None) -> DataFrame:
    """All open archive tasks with source and target; a task without a route carries its error.

    `routes` is the handful of layer folders, so it is broadcast.
    """
    todo = ledger.pending_tasks(
        tasks, event_type=ledger.ARCHIVE, dataset=ledger.DATASET, limit=limit
    )
    unknown = F.concat(F.lit("no archive folder is set for "), F.col("dataset"), F.lit("/"), F.col("layer"))
    return todo.join(F.broadcast(routes), ["dataset", "layer"], "left").select(
        *(todo[c] for c in ledger.TASK_KEY),
        "attempts",
        "source",
        "archive",
        F.when(F.col("source").isNull(), unknown).alias("error"),
    )


def archive_outcomes(plan: DataFrame, archived: DataFrame, active: DataFrame) -> DataFrame:
    """The fate of every planned task, from listings (layer, object_name) of both folders.

    archived: in the archive; failed: no route; waiting: still in the active folder;
    skipped: in neither, which counts as done.
    """
    def listing(files: DataFrame, flag: str) -> DataFrame:
        return files.select("layer", F.col("object_name").alias("partition_key")).distinct().withColumn(
            flag, F.lit(True)
        )

    on = ["layer", "partition_key"]
    return (
        plan.join(listing(archived, "in_archive"), on, "left")
        .join(listing(active, "in_active"), on, "left")
        .select(
            *ledger.TASK_KEY,
            "error",
            F.when(F.col("error").isNotNull(), "failed")
            .when(F.col("in_archive"), "archived")
            .when(F.col("in_active"), "waiting")
            .otherwise("skipped")
            .alias("outcome"),
        )
    )


def archive_report(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count_if(F.col("outcome") != "waiting").alias("taken"),
        *(F.count_if(F.col("outcome") == o).alias(o) for o in ("archived", "failed", "skipped")),
    )


def retention_plan(archive: DataFrame, before: datetime) -> DataFrame:
    """Archived files last modified before a time: per layer how many, how many rows and bytes.

    `archive` has layer, object_name, rows, bytes and modified_at.
    """
    return (
        archive.filter(F.col("modified_at") < F.lit(str(before)).cast("timestamp_ntz"))
        .groupBy("layer")
        .agg(
            F.count("*").alias("files"),
            F.sum("rows").alias("rows"),
            F.sum("bytes").alias("bytes"),
            F.min("modified_at").alias("oldest"),
        )
    )
