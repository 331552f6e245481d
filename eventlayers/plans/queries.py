"""Every operator as a query over the shared tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlayers.functions import dated_object_name, keep_where, with_url_parts
from eventlayers.operators import (
    analytics,
    archive,
    gold,
    ledger,
    marts,
    monitoring,
    rollups,
    runs,
    silver,
    star,
    watermarks,
)
from eventlayers.schemas import BRONZE, RUN_COUNTERS, RUN_LOG, TASK_KEY, TASK_LOG, names
from eventlayers.session import scratch_dir
from eventlayers.sources import event_table as et
from eventlayers.sources import layers, messages
from eventlayers.sources.layers import flatten_batches
from eventlayers.streaming import jobs, offsets

Query = Callable[[SparkSession, str], DataFrame]

_SEQ = 1_000_000_000_000


def _now() -> Column:
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def _views(spark: SparkSession, sf: str) -> DataFrame:
    return marts.mart_rows(gold.page_views(et.silver_events(et.read_events(spark, sf))), gold.PAGE_VIEWS)


def _products(spark: SparkSession, sf: str) -> DataFrame:
    return marts.mart_rows(
        gold.product_events(et.silver_events(et.read_events(spark, sf))), gold.PRODUCT_EVENTS
    )


# --- analytics -----------------------------------------------------------------------------


def top_landing_pages(spark, sf):
    return analytics.top_landing_pages(_views(spark, sf))


def page_stats(spark, sf):
    return analytics.page_stats(_views(spark, sf))


def top_products(spark, sf):
    return analytics.top_products(_products(spark, sf))


def product_stats(spark, sf):
    return analytics.product_stats(_products(spark, sf)).withColumn(
        "total_revenue", F.col("total_revenue").cast("double")
    )


def ab_test_summary(spark, sf):
    return analytics.ab_test_summary(_views(spark, sf), _products(spark, sf))


def user_sessions(spark, sf):
    return analytics.user_sessions(_views(spark, sf), "u7", skip=2)


def user_total_sessions(spark, sf):
    return analytics.user_total_sessions(_views(spark, sf), "u7")


# --- URLs ----------------------------------------------------------------------------------


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.schema("page_id long, url string").parquet(f"{sf}/pages.parquet")
    return with_url_parts(pages, "url").drop("url")


def url_parts(spark, sf):
    return _pages(spark, sf)


def page_sections(spark, sf):
    return _pages(spark, sf).groupBy("page_section").agg(F.count("*").alias("pages"))


# --- layers --------------------------------------------------------------------------------


def bronze_to_silver(spark, sf):
    return silver.bronze_to_silver(et.raw_events(et.read_events(spark, sf)))


def silver_rejects(spark, sf):
    rejects = silver.silver_rejects(et.raw_events(et.read_events(spark, sf)))
    return rejects.select("event_id", "raw_event_time", "page_url", "reason")


def gold_page_views(spark, sf):
    return gold.page_views(et.silver_events(et.read_events(spark, sf)))


def gold_product_events(spark, sf):
    return gold.product_events(et.silver_events(et.read_events(spark, sf)))


def gold_split(spark, sf):
    return gold.routed(et.silver_events(et.read_events(spark, sf)))


def gold_split_counts(spark, sf):
    return gold_split(spark, sf).groupBy("route").agg(F.count("*").alias("n"))


def mart_page_views(spark, sf):
    return _views(spark, sf).drop("created_at")


def mart_product_events(spark, sf):
    return _products(spark, sf).drop("created_at").withColumn("price", F.col("price").cast("double"))


def mart_rejects(spark, sf):
    """Rows a mart refuses: here missing sessions, long groups, prices too large."""
    event = F.col("event_id")
    broken = et.web_events(et.read_events(spark, sf)).withColumns(
        {
            "session_id": F.when(event % 10 != 0, F.col("session_id")),
            "ab_group": F.when(event % 10 == 1, F.repeat(F.lit("x"), 51)).otherwise(F.col("ab_group")),
            "price": F.when(event % 10 == 2, 1e9).when(event % 10 == 3, float("nan")).otherwise(F.col("price")),
        }
    )
    rejects = marts.mart_rejects(gold.product_events(broken), gold.PRODUCT_EVENTS)
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


# --- messages ------------------------------------------------------------------------------


def decode_messages(spark, sf):
    decoded = messages.accepted(messages.decode(et.topic_messages(et.read_events(spark, sf))))
    return decoded.select(
        *(n for n in names(BRONZE) if n not in ("extra", "extra_other")),
        F.col("extra").isNull().alias("extra_is_null"),
        "extra.ab_group",
        "extra.scroll_depth",
    )


def quarantine_reasons(spark, sf):
    decoded = messages.decode(et.topic_messages(et.read_events(spark, sf)))
    return messages.quarantined(decoded).groupBy("reason").agg(F.count("*").alias("n"))


def next_offsets(spark, sf):
    return messages.next_offsets(et.topic_messages(et.read_events(spark, sf)))


def _sent_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a topic of three partitions for each type, which leave each other's offsets out."""
    return et.read_events(spark, sf).select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset")
    )


def offset_gaps(spark, sf):
    return offsets.offset_gaps(_sent_by_type(spark, sf))


def contiguous_offsets(spark, sf):
    return offsets.contiguous_offsets(_sent_by_type(spark, sf))


def publish_roundtrip(spark, sf):
    """Events to message key and text and back."""
    rows = et.raw_events(et.read_events(spark, sf), faults=False)
    sent = messages.encode(rows, "topic", "partition", "offset", F.col("sent_at").alias("timestamp"))
    back = messages.decode(sent, F.col("key").cast("string").alias("key"))
    return keep_where(back, F.col("reason").isNull()).select(
        "offset", "event_type", "page_url", "price", "extra.*", "key"
    )


def flatten(spark, sf):
    """Rows held as batches of batches, back to rows: each event once as it is, once as a copy."""
    row = F.struct(F.col("event_id"), F.col("event_type"), F.lit(0).alias("copy"))
    copy = F.struct(F.col("event_id"), F.upper("event_type").alias("event_type"), F.lit(1).alias("copy"))
    batches = F.array(F.array(row, copy), F.array(row)).alias("batches")
    return flatten_batches(et.read_events(spark, sf).select(batches), "batches")


# --- task log ------------------------------------------------------------------------------


def _hour_files(spark: SparkSession, sf: str) -> DataFrame:
    return et.files(et.read_events(spark, sf))


def _task_log(files: DataFrame) -> DataFrame:
    """Up to three states per hourly file, by the number of its last event; every fourth has none."""
    n = F.col("last_id")
    layer = (
        F.when(n % 5 == 0, "silver").when(n % 5 == 1, "gold_page_views").when(n % 5 == 2, "lost")
        .otherwise("bronze")
    )

    def state(step: int, status: str, attempts: int) -> Column:
        at = F.timestamp_add("MINUTE", F.lit(step), F.col("modified_at"))
        return F.struct(
            F.lit(status).alias("status"),
            F.lit(attempts).alias("attempts"),
            at.cast("timestamp").alias("updated_at"),
            (n * 4 + step).alias("seq"),
        )

    first = state(0, ledger.PENDING, 0)
    history = (
        F.when(n % 4 == 0, F.array(first, state(1, ledger.IN_PROGRESS, 1), state(2, ledger.DONE, 1)))
        .when(n % 4 == 1, F.array(first))
        .when(n % 4 == 2, F.array(first, state(1, ledger.FAILED, 5)))
    )
    history = F.when(n % 12 == 6, F.array(first, state(1, ledger.FAILED, 2))).otherwise(history)
    history = F.when(n % 28 == 13, F.array(first, state(1, "CANCELLED", 0))).otherwise(history)
    values = {
        "event_type": F.lit(ledger.ARCHIVE),
        "dataset": F.lit(ledger.DATASET),
        "layer": layer,
        "partition_key": F.col("object_name"),
        "next_retry_at": F.col("modified_at"),
        "last_error": F.when(F.col("s.status") == ledger.FAILED, "lost"),
        "created_at": F.col("modified_at"),
    }
    return files.select("*", F.explode(history).alias("s")).select(
        *(
            (values[f.name] if f.name in values else F.col(f"s.{f.name}")).cast(f.dataType).alias(f.name)
            for f in TASK_LOG
        )
    )


def _utc_text(*columns: str) -> dict[str, Column]:
    return {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in columns}


def _shown(tasks: DataFrame) -> DataFrame:
    return tasks.drop("next_retry_at").withColumns(_utc_text("created_at", "updated_at"))


def current_tasks(spark, sf):
    return _shown(ledger.current_tasks(_task_log(_hour_files(spark, sf))))


def task_history(spark, sf):
    """The latest state a user's events leave behind: the task reduction at full event volume."""
    events = et.read_events(spark, sf)
    status = (
        F.when(F.col("event_type") == "purchase", ledger.DONE)
        .when(F.col("event_type") == "error", ledger.FAILED)
        .when(F.col("event_type") == "click", ledger.IN_PROGRESS)
        .otherwise(ledger.PENDING)
    )
    values = {
        "event_type": F.lit(ledger.ARCHIVE),
        "dataset": F.lit(ledger.DATASET),
        "layer": F.lit("bronze"),
        "partition_key": F.col("user_id"),
        "status": status,
        "attempts": F.col("event_id") % 6,
        "updated_at": F.col("ts"),
        "seq": F.col("event_id"),
    }
    log = events.select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TASK_LOG))
    return ledger.current_tasks(log).select("partition_key", "status", "attempts", "seq")


def existing_keys(spark, sf):
    files = _hour_files(spark, sf)
    keys = files.filter("rows % 2 = 0").select(F.col("object_name").alias("partition_key"))
    return ledger.existing_keys(_task_log(files), keys, ledger.DATASET, "bronze")


def unprocessed_files(spark, sf):
    files = _hour_files(spark, sf)
    return ledger.unprocessed_files(files, _task_log(files), "bronze").select("object_name", "rows")


def file_progress(spark, sf):
    files = _hour_files(spark, sf)
    return ledger.file_progress(files, _task_log(files), "bronze")


def pending_tasks(spark, sf):
    tasks = ledger.current_tasks(_task_log(_hour_files(spark, sf)))
    return _shown(ledger.pending_tasks(tasks, dataset=ledger.DATASET, layer="bronze"))


def latest_tasks(spark, sf):
    return _shown(ledger.latest_tasks(ledger.current_tasks(_task_log(_hour_files(spark, sf)))))


def task_status_counts(spark, sf):
    return ledger.status_counts(ledger.current_tasks(_task_log(_hour_files(spark, sf))))


def enqueue_tasks(spark, sf):
    """All hourly files offered to the bronze queue, event by event."""
    events = et.read_events(spark, sf)
    keys = events.select(
        F.lit(ledger.DATASET).alias("dataset"),
        F.lit("bronze").alias("layer"),
        et.hourly_file(F.col("ts")).alias("partition_key"),
    )
    new = ledger.enqueue(_task_log(_hour_files(spark, sf)), keys, _now(), F.lit(_SEQ))
    return new.select(*TASK_KEY, "status", "attempts", "seq")


def _transitions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Every event asks for a state of its hour's task; only the first request of a task counts."""
    files = _hour_files(spark, sf)
    tasks = ledger.current_tasks(_task_log(files))
    asked = (
        F.when(F.col("event_id") % 3 == 0, ledger.DONE)
        .when(F.col("event_id") % 3 == 1, ledger.FAILED)
        .otherwise(ledger.IN_PROGRESS)
    )
    requests = et.read_events(spark, sf).select(
        F.lit(ledger.ARCHIVE).alias("event_type"),
        F.lit(ledger.DATASET).alias("dataset"),
        F.lit("bronze").alias("layer"),
        et.hourly_file(F.col("ts")).alias("partition_key"),
        F.col("event_id").alias("request_id"),
        asked.alias("to_status"),
        F.repeat(F.lit("lost "), 200).alias("error"),
    )
    # Claimed tasks are put back in progress so that every guard has tasks to pass.
    running = tasks.withColumn(
        "status", F.when(F.col("status") == ledger.DONE, ledger.IN_PROGRESS).otherwise(F.col("status"))
    )
    return ledger.apply_transitions(running, requests, _now(), F.lit(_SEQ))


def apply_transitions(spark, sf):
    taken, _ = _transitions(spark, sf)
    return taken.select("layer", "partition_key", "status", "attempts", "last_error", "seq")


def refused_transitions(spark, sf):
    _, refused = _transitions(spark, sf)
    return refused.select("partition_key", "request_id", "to_status")


def _plan(spark: SparkSession, sf: str) -> DataFrame:
    tasks = ledger.current_tasks(_task_log(_hour_files(spark, sf)))
    return archive.archive_plan(tasks, archive.default_routes(spark, "layers"))


def archive_plan(spark, sf):
    return _plan(spark, sf)


def archive_report(spark, sf):
    """Planned files whose row count is a multiple of 3 are archived, of 2 still active."""
    plan = _plan(spark, sf)
    files = _hour_files(spark, sf).join(
        plan.select("layer", F.col("partition_key").alias("object_name")), "object_name"
    )
    outcomes = archive.archive_outcomes(plan, files.filter("rows % 3 = 0"), files.filter("rows % 2 = 0"))
    return archive.archive_report(outcomes)


def retention_plan(spark, sf):
    files = _hour_files(spark, sf).withColumn("layer", F.lit("bronze"))
    return archive.retention_plan(files, datetime(2024, 1, 23))


# --- watermarks and runs -------------------------------------------------------------------


def watermark_upsert(spark, sf):
    events = et.read_events(spark, sf)
    log = events.select(
        F.lit(ledger.DATASET).alias("dataset"),
        F.col("event_type").alias("layer"),
        F.when(F.col("event_type") != "error", F.col("ts")).alias("last_processed_ts"),
        F.when(F.col("event_id") % 4 == 0, F.col("value").cast("long")).alias("last_processed_id"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("seq"),
    )
    return watermarks.current_watermarks(log)


def layer_watermark(spark, sf):
    silver_rows = et.silver_events(et.read_events(spark, sf))
    return watermarks.layer_watermark(silver_rows, ledger.DATASET, "bronze_to_silver")


def _run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Each event is a run: started at its time, ended `value` seconds later unless it is a view."""
    kind, n = F.col("event_type"), F.col("event_id")
    end = F.timestamp_add("MICROSECOND", F.round(F.col("value") * 1_000_000).cast("long"), F.col("ts"))
    status = F.when(kind == "error", runs.FAILED).otherwise(runs.SUCCESS)

    def state(status: Column, at: Column, seq: int, counted: Column) -> Column:
        counts = [F.when(counted, n % (7 + i)).alias(c) for i, c in enumerate(runs.RUN_COUNTERS)]
        error = F.when(status == runs.FAILED, F.repeat(kind, 200)).alias("error_message")
        return F.struct(status.alias("status"), error, at.cast("timestamp").alias("at"), F.lit(seq).alias("seq"), *counts)

    started = state(F.lit(runs.RUNNING), F.col("ts"), 0, F.lit(False))
    ended = state(status, end, 1, kind != "error")
    states = F.when(kind == "view", F.array(started)).otherwise(F.array(started, ended))
    log = et.read_events(spark, sf).select(
        F.lpad(n.cast("string"), 12, "0").alias("run_id"), F.inline(states)
    )
    return log.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_LOG))


def _shown_runs(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        _utc_text("started_at", "finished_at") | {"duration_seconds": F.col("duration_seconds").cast("double")}
    )


def run_history(spark, sf):
    return _shown_runs(runs.with_totals(runs.run_history(_run_log(spark, sf))))


def latest_runs(spark, sf):
    return _shown_runs(runs.latest_runs(runs.run_history(_run_log(spark, sf))))


# --- star ----------------------------------------------------------------------------------


def _star(spark: SparkSession, sf: str) -> star.Star:
    """Every third user and the sessions of every seventh user are known beforehand."""
    events = et.read_events(spark, sf)
    records = et.session_records(events)
    known = star.checked(records).filter("session_uuid IS NOT NULL")
    users = events.filter("user_id % 3 = 0").select("user_id").distinct()
    sessions = known.filter("user_id % 7 = 0").select(F.col("session_uuid").alias("session_id")).distinct()
    return star.process_records(records, users, sessions, F.col("event_id"), F.col("event_id"))


def dim_users(spark, sf):
    return _star(spark, sf).users


def dim_sessions(spark, sf):
    return _star(spark, sf).sessions


def fact_events(spark, sf):
    return _star(spark, sf).events


def skipped_sessions(spark, sf):
    return star.skipped_sessions(_star(spark, sf).rejects)


def skipped_count(spark, sf):
    return star.skipped_count(_star(spark, sf).rejects)


# --- monitoring ----------------------------------------------------------------------------


def layer_stats(spark, sf):
    """Layers of the events table, one file per event hour."""
    events = et.read_events(spark, sf)
    rows = et.silver_events(events).withColumn("object_name", et.hourly_file(F.col("event_time")))
    views = rows.filter(gold.is_page_view(F.col("page_url")))
    products = rows.filter(gold.is_product_event(F.col("product_id")))
    return monitoring.layer_stats(
        monitoring.file_counts(events.select(et.hourly_file(F.col("ts")).alias("object_name")), "bronze"),
        monitoring.file_counts(rows, "silver"),
        monitoring.file_counts(views, gold.PAGE_VIEWS),
        monitoring.file_counts(products, gold.PRODUCT_EVENTS),
    )


# --- streaming -----------------------------------------------------------------------------


class _CrashOnce:
    """Fails the first batch after it was written and before it is committed."""

    def __init__(self):
        self.armed = True

    def __call__(self, batch_id: int) -> None:
        if self.armed:
            self.armed = False
            raise RuntimeError("crash between write and commit")


def _crash(start: Callable[..., jobs.Job]) -> None:
    """Start a hop whose first batch fails after it was written and handed over."""
    try:
        jobs.finish(start(after_write=_CrashOnce()))
    except Exception as error:
        if "crash between write and commit" not in str(error):
            raise


_MARTS = (gold.PAGE_VIEWS, gold.PRODUCT_EVENTS)


def _drained(
    spark: SparkSession, sf: str, crash: bool = False, tables: tuple[str, ...] = _MARTS
) -> jobs.Layout:
    """The events table as a topic, carried to the marts by the streaming jobs."""
    layout = jobs.Layout(scratch_dir(spark, "layers"))
    topic = et.topic_messages(et.stream_events(spark, sf))

    def settle(start: Callable[..., jobs.Job]) -> None:
        if crash:
            _crash(start)
        jobs.finish(start())

    settle(lambda **h: jobs.ingest(topic, layout, **h))
    settle(lambda **h: jobs.bronze_to_silver(spark, layout, **h))
    settle(lambda **h: jobs.silver_to_gold(spark, layout, **h))
    for table in tables:
        settle(lambda table=table, **h: jobs.load_mart(spark, layout, table, **h))
    return layout


def _layer_rows(spark: SparkSession, layout: jobs.Layout) -> DataFrame:
    parts = [
        spark.read.schema("route string").parquet(layout.layer(name)).select(F.lit(name).alias("layer"), "route")
        for name in ("bronze", "silver", "gold", "mart_page_views", "mart_product_events")
    ]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("layer", "route").agg(F.count("*").alias("n"))


def stream_layer_counts(spark, sf):
    return _layer_rows(spark, _drained(spark, sf))


def stream_replay_no_duplicates(spark, sf):
    """Every hop crashes once between write and commit and is started again: same counts."""
    return _layer_rows(spark, _drained(spark, sf, crash=True))


def stream_replay_after_archive(spark, sf):
    """A hop crashes after it handed its files over; the archive runs, twice, before each hop is started again."""
    root = scratch_dir(spark, "layers")
    layout = jobs.Layout(f"{root}/active", archive_root=f"{root}/archive")
    jobs.finish(jobs.ingest(et.topic_messages(et.stream_events(spark, sf)), layout))
    starts = [
        lambda **h: jobs.bronze_to_silver(spark, layout, **h),
        lambda **h: jobs.silver_to_gold(spark, layout, **h),
        *(lambda table=table, **h: jobs.load_mart(spark, layout, table, **h) for table in (gold.PAGE_VIEWS, gold.PRODUCT_EVENTS)),
    ]
    for start in starts:
        _crash(start)
        jobs.settle_archive(spark, layout)
        jobs.finish(start())
        jobs.settle_archive(spark, layout)
    return _layer_counts(spark, layout)


def _layer_counts(spark: SparkSession, layout: jobs.Layout) -> DataFrame:
    """Rows of every layer and route by their commit entries, wherever the files are now."""
    found = None
    for layer in jobs.WRITERS:
        lines = layers.read_entries(spark, layout.layer(layer)).filter(F.col("file").isNotNull())
        rows = lines.groupBy(F.lit(layer).alias("layer"), "route").agg(F.sum("rows").alias("n"))
        found = rows if found is None else found.unionByName(rows)
    return found


def lake_compacted(spark, sf):
    """Tasks and rows of a lake whose logs were compacted, and filled again, and compacted again."""
    layout = jobs.Layout(scratch_dir(spark, "layers"))
    topic = et.topic_messages(et.stream_events(spark, sf))
    jobs.finish(jobs.ingest(topic, layout))
    for _ in range(2):
        jobs.run_full(spark, layout)
        jobs.compact(spark, layout, least=1)
    return _layer_counts(spark, layout)


def stream_mart_page_views(spark, sf):
    layout = _drained(spark, sf, tables=(gold.PAGE_VIEWS,))
    rows = jobs.read_mart(spark, layout, gold.PAGE_VIEWS)
    return rows.drop("created_at", "event_date")


def stream_user_sessions(spark, sf):
    """One user's sessions from the mart files that the commit entries name for the user."""
    layout = _drained(spark, sf, tables=(gold.PAGE_VIEWS,))
    return analytics.user_sessions(jobs.lookup(spark, layout, gold.PAGE_VIEWS, "u7"), "u7")


def stream_mart_product_events(spark, sf):
    layout = _drained(spark, sf, tables=(gold.PRODUCT_EVENTS,))
    rows = jobs.read_mart(spark, layout, gold.PRODUCT_EVENTS)
    return rows.drop("created_at", "event_date").withColumn("price", F.col("price").cast("double"))


def _rows_behind(spark: SparkSession, layout: jobs.Layout, tasks: DataFrame, name: str) -> DataFrame:
    """Rows of the files of the tasks, per layer, by the entries."""
    found = None
    for layer, (folder, route) in jobs.FILES.items():
        lines = layers.read_entries(spark, layout.layer(folder)).filter(F.col("route") == route)
        own = lines.select(F.lit(layer).alias("layer"), F.col("file").alias("partition_key"), "rows")
        found = own if found is None else found.unionByName(own)
    return tasks.join(found, ["layer", "partition_key"]).groupBy("layer").agg(F.sum("rows").alias(name))


def stream_tasks(spark, sf):
    """Tasks of each layer, as the rows of the files that they stand for."""
    layout = _drained(spark, sf)
    return _rows_behind(spark, layout, ledger.current_tasks(jobs.read_log(spark, layout, "tasks")), "rows")


def _settled_lake(spark: SparkSession, sf: str) -> tuple[jobs.Layout, list[dict[str, int]]]:
    root = scratch_dir(spark, "layers")
    layout = jobs.Layout(f"{root}/active", archive_root=f"{root}/archive")
    jobs.finish(jobs.ingest(et.topic_messages(et.stream_events(spark, sf)), layout))
    return layout, [jobs.run_full(spark, layout) for _ in range(2)]


def stream_run_full(spark, sf):
    """The run records of two full runs: all counters of the first, and zeros."""
    layout, _ = _settled_lake(spark, sf)
    history = runs.run_history(jobs.read_log(spark, layout, "runs"))
    number = F.row_number().over(Window.orderBy("started_at"))
    return history.select(number.alias("run"), "status", *RUN_COUNTERS)


def archive_settled(spark, sf):
    """A lake that was filled, drained and archived: rows behind done tasks, left in the layers, and in archived files."""
    layout, _ = _settled_lake(spark, sf)
    jobs.settle_archive(spark, layout)
    tasks = ledger.current_tasks(jobs.read_log(spark, layout, "tasks")).filter(F.col("status") == ledger.DONE)
    active = jobs.stats(spark, layout).select("layer", F.col("rows").alias("active_rows"))
    archived = None
    for layer in jobs.FILES:
        place = layout.archive(layer)
        rows = spark.read.schema("route string").parquet(place) if layers.exists(spark, place) else spark.createDataFrame([], "route string")
        counted = rows.agg(F.count("*").alias("archived_rows")).select(F.lit(layer).alias("layer"), "archived_rows")
        archived = counted if archived is None else archived.unionByName(counted)
    return _rows_behind(spark, layout, tasks, "done_rows").join(active, "layer").join(archived, "layer")


def layer_files(spark, sf):
    """The events written out by day, scanned back from the files, and keyed by place: rows and keys of each day."""
    rows = et.silver_events(et.read_events(spark, sf))
    path = scratch_dir(spark, "written")
    layers.write_layer(rows.withColumn("day", F.col("event_time").cast("date")), path, ["day"])
    scanned = layers.scan_files(spark, path, rows.schema, key=star.file_event_key())
    day = dated_object_name(F.col("event_time"))
    return scanned.groupBy(F.regexp_extract(day, r"\A(.*)/", 1).alias("folder")).agg(
        F.count("*").alias("rows"), F.count_distinct("event_key").alias("keys"),
        F.count_if(F.col("object_name").startswith("day=") & F.col("filename").endswith(".parquet")).alias("named"),
    )


def stream_dedupe(spark, sf):
    """Each message twice in the topic, kept once."""
    topic = et.topic_messages(et.stream_events(spark, sf), faults=False)
    path = scratch_dir(spark, "deduped")
    query = (
        messages.dedupe_by_offset(topic.unionByName(topic), within="1 hour").select("topic", "partition", "offset")
        .writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
        .start(f"{path}/rows", format="parquet")
    )
    query.awaitTermination()
    rows = spark.read.parquet(f"{path}/rows")
    return rows.groupBy("partition").agg(F.count("*").alias("rows"), F.count_distinct("offset").alias("offsets"))


def stream_dedupe_runs(spark, sf):
    """Each message twice in the topic, and the topic sent again by a second run: kept once without a time bound."""
    sent = et.topic_messages(et.read_events(spark, sf), faults=False).select("topic", "partition", "offset")
    path = scratch_dir(spark, "deduped")
    for _ in range(2):
        sent.unionByName(sent).write.mode("append").parquet(f"{path}/topic")
        topic = spark.readStream.schema(sent.schema).parquet(f"{path}/topic")
        query = (
            offsets.dedupe_by_runs(topic)
            .writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
            .start(f"{path}/rows", format="parquet")
        )
        query.awaitTermination()
    rows = spark.read.parquet(f"{path}/rows")
    return rows.groupBy("partition").agg(F.count("*").alias("rows"), F.count_distinct("offset").alias("offsets"))


def stream_rollups(spark, sf):
    """Pages, products, A/B groups and users by the states of the marts, one line each."""
    layout = _drained(spark, sf)
    states = []
    for table in _MARTS:
        jobs.finish(jobs.roll_up(spark, layout, table))
        states.append(jobs.read_states(spark, layout, table))
    views, products = states
    by_user = views.filter(F.col("route") == rollups.USERS).groupBy("key").agg(
        F.sum("rows").alias("rows"), F.count_distinct(F.coalesce("session_id", F.lit(""))).alias("other")
    )
    groups = rollups.ab_test_summary(views, products)
    parts = (
        rollups.page_stats(views).select(F.lit("page").alias("report"), F.col("page_url").alias("key"), F.col("page_views").alias("rows"),
                                         F.col("bounces").alias("other"), F.lit(None).cast("double").alias("amount")),
        rollups.product_stats(products).select(F.lit("product").alias("report"), F.col("product_id").alias("key"), F.col("events_count").alias("rows"),
                                               F.lit(None).cast("bigint").alias("other"), F.col("total_revenue").cast("double").alias("amount")),
        groups.select(F.lit("group").alias("report"), F.col("ab_group").alias("key"), F.col("page_views").alias("rows"),
                      F.col("sessions_with_product").alias("other"), F.col("product_events").cast("double").alias("amount")),
        by_user.select(F.lit("user").alias("report"), "key", "rows", "other", F.lit(None).cast("double").alias("amount")),
    )
    return reduce(DataFrame.unionByName, parts)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        top_landing_pages, page_stats, top_products, product_stats, ab_test_summary,
        user_sessions, user_total_sessions, url_parts, page_sections,
        bronze_to_silver, silver_rejects, gold_page_views, gold_product_events, gold_split,
        gold_split_counts, mart_page_views, mart_product_events, mart_rejects,
        decode_messages, quarantine_reasons, next_offsets, publish_roundtrip, flatten,
        current_tasks, task_history, existing_keys, unprocessed_files, file_progress,
        pending_tasks, latest_tasks, task_status_counts, enqueue_tasks, apply_transitions,
        refused_transitions, archive_plan, archive_report, retention_plan,
        watermark_upsert, layer_watermark, run_history, latest_runs,
        dim_users, dim_sessions, fact_events, skipped_sessions, skipped_count,
        layer_stats, layer_files, stream_dedupe, stream_dedupe_runs, stream_rollups, offset_gaps, contiguous_offsets,
        stream_layer_counts, stream_replay_no_duplicates, stream_replay_after_archive, lake_compacted, stream_mart_page_views,
        stream_mart_product_events, stream_user_sessions, stream_tasks, stream_run_full, archive_settled,
    )
}
