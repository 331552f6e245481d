"""The task log: one row per state a file task has been in, newest `seq` wins.

There is one writer at a time; nothing is updated in place. A task's key is
(event_type, dataset, layer, partition_key).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlayers.functions import truncate_error
from eventlayers.schemas import TASK_KEY, TASK_LOG, names

# Fixed values.
ARCHIVE = "ARCHIVE"
DATASET = "web_events"
PENDING, IN_PROGRESS, DONE, FAILED = "PENDING", "IN_PROGRESS", "DONE", "FAILED"
STATUSES = (PENDING, IN_PROGRESS, DONE, FAILED)
MAX_ATTEMPTS = 5
PENDING_LIMIT = 50
LATEST_LIMIT = 5

_KEY = list(TASK_KEY)


def current_tasks(log: DataFrame) -> DataFrame:
    """The newest row of every task."""
    rest = [c for c in names(TASK_LOG) if c not in TASK_KEY]
    newest = F.max_by(F.struct(*rest), F.col("seq")).alias("t")
    return log.groupBy(*_KEY).agg(newest).select(*_KEY, *(f"t.{c}" for c in rest))


def is_open(status: Column, attempts: Column) -> Column:
    """Waiting, or failed with attempts left."""
    return status.isin(PENDING, FAILED) & (attempts < MAX_ATTEMPTS)


def existing_keys(
    log: DataFrame, keys: DataFrame, dataset: str, layer: str, event_type: str = ARCHIVE
) -> DataFrame:
    """Those of `keys` (column partition_key) that have a task. No keys, no rows."""
    tasks = log.filter(
        (F.col("event_type") == event_type) & (F.col("dataset") == dataset) & (F.col("layer") == layer)
    )
    return keys.select("partition_key").distinct().join(tasks, "partition_key", "left_semi")


def unprocessed_files(
    files: DataFrame, log: DataFrame, layer: str, dataset: str = DATASET, event_type: str = ARCHIVE
) -> DataFrame:
    """Files (column object_name) that were not handed over yet."""
    done = log.filter(
        (F.col("event_type") == event_type) & (F.col("dataset") == dataset) & (F.col("layer") == layer)
    )
    return files.join(done, files["object_name"] == done["partition_key"], "left_anti")


def file_progress(files: DataFrame, log: DataFrame, layer: str) -> DataFrame:
    """Files of a layer: all, those already handed over (skipped), and the rest."""
    done = existing_keys(log, files.select(F.col("object_name").alias("partition_key")), DATASET, layer)
    marked = files.join(
        done.withColumn("done", F.lit(True)), files["object_name"] == done["partition_key"], "left"
    )
    return marked.agg(
        F.count("*").alias("files"),
        F.count("done").alias("skipped_files"),
        (F.count("*") - F.count("done")).alias("new_files"),
    )


def enqueue(log: DataFrame, keys: DataFrame, now: Column, seq: Column) -> DataFrame:
    """Log rows for those keys (dataset, layer, partition_key) that have no task: the rows to append."""
    asked = keys.select(
        F.lit(ARCHIVE).alias("event_type") if "event_type" not in keys.columns else F.col("event_type"),
        "dataset",
        "layer",
        "partition_key",
    ).distinct()
    values = {
        "status": F.lit(PENDING),
        "attempts": F.lit(0),
        "next_retry_at": now,
        "last_error": F.lit(None),
        "created_at": now,
        "updated_at": now,
        "seq": seq,
    }
    return asked.join(log, _KEY, "left_anti").select(
        *(values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in TASK_LOG)
    )


def pending_tasks(
    tasks: DataFrame,
    event_type: str | None = None,
    dataset: str | None = None,
    layer: str | None = None,
    limit: int | None = PENDING_LIMIT,
) -> DataFrame:
    """Open tasks, longest untouched first; without a limit all of them, in no order."""
    asked = {"event_type": event_type, "dataset": dataset, "layer": layer}
    given = [F.col(k) == v for k, v in asked.items() if v]
    found = reduce(DataFrame.filter, given, tasks.filter(is_open(F.col("status"), F.col("attempts"))))
    return found.orderBy("updated_at", *_KEY).limit(limit) if limit is not None else found


def latest_tasks(tasks: DataFrame, limit: int = LATEST_LIMIT) -> DataFrame:
    return tasks.orderBy(F.desc("updated_at"), F.desc("seq"), *_KEY).limit(limit)


def apply_transitions(
    tasks: DataFrame, requests: DataFrame, now: Column, seq: Column
) -> tuple[DataFrame, DataFrame]:
    """Claim, finish or fail tasks as a set.

    `requests` has the task key, `request_id` (orders the requests of one task), `to_status`
    and `error`. The first request of a task is taken if its guard holds; the guards are
    open -> IN_PROGRESS (one more attempt), IN_PROGRESS -> DONE, IN_PROGRESS -> FAILED.
    Returns the rows to append to the log and the requests that were refused.
    """
    first = (
        requests.groupBy(*_KEY)
        .agg(F.min_by(F.struct("request_id", "to_status", "error"), F.col("request_id")).alias("r"))
        .select(*_KEY, "r.request_id", "r.to_status", "r.error")
    )
    status, to_status = F.col("status"), F.col("to_status")
    allowed = (
        F.when(to_status == IN_PROGRESS, is_open(status, F.col("attempts")))
        .when(to_status.isin(DONE, FAILED), status == IN_PROGRESS)
        .otherwise(F.lit(False))
    )
    taken = first.join(tasks, _KEY).filter(allowed)
    changes = {
        "status": to_status,
        "attempts": F.col("attempts") + F.when(to_status == IN_PROGRESS, 1).otherwise(0),
        "last_error": F.when(to_status == FAILED, truncate_error(F.col("error"))).otherwise(
            F.col("last_error")
        ),
        "updated_at": now,
        "seq": seq,
    }
    appended = taken.select(
        *(changes.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in TASK_LOG)
    )
    refused = requests.join(taken.select(*_KEY, "request_id"), [*_KEY, "request_id"], "left_anti")
    return appended, refused


def status_counts(tasks: DataFrame) -> DataFrame:
    """Tasks per status, zero for the known ones without tasks, and their TOTAL."""
    spark = tasks.sparkSession
    known = spark.createDataFrame([(s,) for s in STATUSES], "status string")
    counts = tasks.groupBy("status").agg(F.count("*").alias("n"))
    return (
        counts.join(known, "status", "full_outer")
        .rollup("status")
        .agg(F.sum(F.coalesce("n", F.lit(0))).alias("tasks_count"), F.grouping("status").alias("all"))
        .select(
            F.when(F.col("all") == 1, "TOTAL").otherwise(F.col("status")).alias("status"), "tasks_count"
        )
    )
