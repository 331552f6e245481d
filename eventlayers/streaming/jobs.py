"""Layer hops as checkpointed streaming queries.

Each hop follows the commit log of a layer, reads the files of new entries, writes one folder per
batch and commits it with an entry of its own. A replayed batch finds its rows committed, or writes
them again; it overwrites its own file tasks and watermark. So a crash at any point leaves no
duplicates and loses nothing, on file systems and object stores alike, and a hop may run while
the one before it does. What a checkpoint has not committed may be replayed, so it is a fence: files of
such batches are not archived, and entries that a hop may ask for again are not compacted.
One run of a hop at a time, as with any checkpoint; `run_full`, `settle_archive` and `compact` hold a lease.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventlayers.functions import key_part
from eventlayers.operators import archive, gold, ledger, marts, monitoring, rollups, runs, silver
from eventlayers.schemas import (
    BRONZE,
    GOLD_PAGE_VIEW,
    GOLD_PRODUCT_EVENT,
    MART_PAGE_VIEW,
    MART_PRODUCT_EVENT,
    RUN_COUNTERS,
    RUN_LOG,
    SILVER,
    TASK_LOG,
    WATERMARK_LOG,
    names,
)
from eventlayers.sources import files, layers, manifests, messages
from eventlayers.streaming import leases

# Triggers: work off what is there and stop, or follow the topic in small batches.
DRAIN = {"availableNow": True}
FOLLOW = {"processingTime": f"{messages.FLUSH_SECONDS} seconds"}

# What a hop reads of its layer; columns left out here are not read from the files.
_BRONZE_READ = T.StructType([f for f in BRONZE if f.name != "extra_other"])
_SILVER_READ = T.StructType(
    [f for f in SILVER if f.name in (*names(GOLD_PAGE_VIEW), *names(GOLD_PRODUCT_EVENT))]
)

# Routes of a layer: its rows and the rows left out of it. Gold has its two outputs as routes.
ROWS, QUARANTINE = "rows", "quarantine"

_LOGS = {"tasks": TASK_LOG, "watermarks": WATERMARK_LOG, "runs": RUN_LOG}

# Mart of each gold output: read schema, mart schema, folder, lookup key, counter.
_MARTS = {
    gold.PAGE_VIEWS: (
        GOLD_PAGE_VIEW, MART_PAGE_VIEW, "mart_page_views", "user_id", "loaded_page_views_count",
    ),
    gold.PRODUCT_EVENTS: (
        GOLD_PRODUCT_EVENT, MART_PRODUCT_EVENT, "mart_product_events", "product_id",
        "loaded_product_events_count",
    ),
}

# Where the files of each task layer lie: layer folder and route.
FILES = {
    "bronze": ("bronze", ROWS),
    "silver": ("silver", ROWS),
    gold.PAGE_VIEWS: ("gold", gold.PAGE_VIEWS),
    gold.PRODUCT_EVENTS: ("gold", gold.PRODUCT_EVENTS),
}

# The hop that writes each layer folder, and the hops that read it; what marts are read by are reports.
WRITERS = {
    "bronze": "ingest",
    "silver": "bronze_to_silver",
    "gold": "silver_to_gold",
    **{target: f"load_{target}" for _, _, target, _, _ in _MARTS.values()},
    **{f"{target}_states": f"roll_up_{target}" for _, _, target, _, _ in _MARTS.values()},
}
READERS = {"bronze": ("silver",), "silver": ("gold",), "gold": tuple(t for _, _, t, _, _ in _MARTS.values())}
# States are made of marts where they are asked for; a mart's entries wait for them once they are.
OPTIONAL_READERS = {target: (f"{target}_states",) for _, _, target, _, _ in _MARTS.values()}
# Folders that are moved at the same time, and failed ones after which moving is given up.
_MOVERS, _MOST_FAILURES = 16, 1000


@dataclass(frozen=True)
class Layout:
    """Folders below one root. With `archive_root`, finished files are moved there."""

    root: str
    archive_root: str | None = None
    # Bounds a batch, so that a backlog is worked off in steps that commit one by one.
    max_batches_per_trigger: int | None = 1000

    def layer(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def archive(self, layer: str) -> str | None:
        return f"{self.archive_root.rstrip('/')}/{layer}" if self.archive_root else None


@dataclass
class Counters:
    """What one job did: a line per batch, summed up by `total`."""

    batches: list[dict] = field(default_factory=list)
    # Files of the source that earlier runs had handed over and that are not archived yet.
    skipped_files: int = 0

    def total(self, name: str) -> int:
        return sum(b.get(name) or 0 for b in self.batches)


Job = tuple[StreamingQuery, Counters]


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _micros(moment: datetime) -> int:
    return int(moment.timestamp() * 1_000_000)


def read_log(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """The task, watermark or run log."""
    return layers.read_log(spark, layout.layer(name), _LOGS[name])


def checkpoint(layout: Layout, job: str) -> str:
    return layout.layer(f"checkpoints/{job}")


def committed(spark: SparkSession, layout: Layout) -> DataFrame:
    """`job, writer, committed`: the id of each hop's query and the newest batch that its checkpoint has committed."""
    rows = []
    for job in WRITERS.values():
        place = checkpoint(layout, job)
        if "metadata" in files.names(spark, place):
            done = [int(n) for n in files.names(spark, f"{place}/commits") if n.isdecimal()]
            rows.append((job, json.loads(files.read_text(spark, f"{place}/metadata"))["id"], max(done, default=-1)))
    return spark.createDataFrame(rows, "job string, writer string, committed bigint")


@contextmanager
def leased(spark: SparkSession, layout: Layout, name: str, owner: str, seconds: float = leases.SECONDS) -> Iterator[leases.Lease]:
    """The lease of a schedule, for the time of the block; raises `leases.LeaseHeld` while another run has it."""
    lease = leases.acquire(spark, layout.layer(f"_leases/{name}"), owner, seconds)
    try:
        yield lease
    finally:
        lease.release()


def _hand_over(spark: SparkSession, layout: Layout, layer: str, read: DataFrame, writer: str, batch_id: int) -> None:
    """Tasks for the files that a batch has read, whether or not they gave it any rows."""
    now = _now()
    keys = read.select(
        F.col("file").alias("partition_key"), F.lit(ledger.DATASET).alias("dataset"), F.lit(layer).alias("layer")
    )
    # A replay must not see the tasks its first try wrote.
    own = (F.col("writer") == writer) & (F.col("batch_id") == batch_id)
    log = read_log(spark, layout, "tasks").filter((F.col("layer") == layer) & ~F.coalesce(own, F.lit(False)))
    new = ledger.enqueue(log, keys, F.lit(now), F.lit(_micros(now)))
    new.write.mode("overwrite").parquet(layers.batch_folder(layout.layer("tasks"), writer, batch_id))


def _handed_over(spark: SparkSession, layout: Layout, layer: str) -> int:
    """Files of a layer that have a task which is not done."""
    tasks = ledger.current_tasks(read_log(spark, layout, "tasks").filter(F.col("layer") == layer))
    return tasks.filter(F.col("status") != ledger.DONE).count()


def _mark(
    spark: SparkSession, layout: Layout, job: str, latest: datetime | None, writer: str, batch_id: int
) -> None:
    now = _now()
    row = [(ledger.DATASET, job, latest, None, now, _micros(now))]
    folder = layers.batch_folder(layout.layer("watermarks"), writer, batch_id)
    spark.createDataFrame(row, WATERMARK_LOG).coalesce(1).write.mode("overwrite").parquet(folder)


@dataclass(frozen=True)
class _Source:
    """A route of a layer as the input of a hop."""

    task_layer: str
    row: T.StructType
    # Whether the watermark is that of the rows read, not of those written.
    marks_read: bool = False

    @property
    def route(self) -> str:
        return FILES[self.task_layer][1]

    def folder(self, layout: Layout) -> str:
        return layout.layer(FILES[self.task_layer][0])


def _rows_of(*routes: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("route").isin(*routes), F.col("rows"))), F.lit(0))


def _start(
    spark: SparkSession,
    stream: DataFrame | _Source,
    layout: Layout,
    job: str,
    target: str,
    transform: Callable[[DataFrame], DataFrame],
    counts: dict[str, str],
    read_count: str,
    date: str = "event_date",
    watermark: bool = False,
    options: dict[str, str] | None = None,
    trigger: dict | None = None,
    after_write: Callable[[int], None] | None = None,
    lease: leases.Lease | None = None,
    key: str | None = None,
) -> Job:
    """Start one hop. `counts` names the route that each counter counts; `after_write` runs between the writes and the
    commit of a batch.

    Counters and watermarks come from the entries of what was read and of what is committed, whose counts are those of
    the files' footers: counts taken while rows are written would count the rows of a repeated task again.
    Under a lease, a run that was taken over neither writes nor commits.
    """
    counters = Counters()
    source = stream if isinstance(stream, _Source) else None
    root = layout.layer(target)
    timed = target != "bronze"
    measured = {name: _rows_of(route) for name, route in counts.items()} | {"rejected": _rows_of(QUARANTINE)}
    if not source:
        measured[read_count] = F.coalesce(F.sum("rows"), F.lit(0))
    elif watermark and not source.marks_read:
        measured["latest"] = F.max(F.when(F.col("route") != QUARANTINE, F.col("last_time").cast("timestamp_ntz")))
    if source:
        counters.skipped_files = _handed_over(spark, layout, source.task_layer)
        stream = layers.stream_commits(spark, source.folder(layout), layout.max_batches_per_trigger)
    check = lease.check if lease else lambda: None

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        writer = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        line = {"batch_id": batch_id}
        if lease:
            lease.renew()
        read = sources = None
        if source:
            sources = batch.select("entry")
            read = batch.filter(F.col("route") == source.route)
            seen = {read_count: F.coalesce(F.sum("rows"), F.lit(0)), "files": F.count("*")}
            if source.marks_read:
                seen["latest"] = F.max(F.col("last_time").cast("timestamp_ntz"))
            line |= read.agg(*(c.alias(n) for n, c in seen.items())).first().asDict()
            batch = layers.read_routes(session, source.folder(layout), source.row, batch, source.route)
        entry = layers.published(session, root, writer, batch_id)
        if entry is None:
            own = layers.tag(writer, lease.number if lease else None)
            entry = layers.publish_batch(
                transform(batch), root, own, batch_id, ["route", date], sources, timed, check, key, **(options or {})
            )
        line |= layers.read_entry(session, root, entry).agg(*(c.alias(n) for n, c in measured.items())).first().asDict()
        if source:
            _hand_over(session, layout, source.task_layer, read, writer, batch_id)
        if watermark:
            _mark(session, layout, job, line["latest"], writer, batch_id)
        if after_write:
            after_write(batch_id)
        counters.batches.append(line)

    query = (
        stream.writeStream.queryName(job)
        .option("checkpointLocation", checkpoint(layout, job))
        .trigger(**(trigger or DRAIN))
        .foreachBatch(write)
        .start()
    )
    return query, counters


def _split(rows: DataFrame) -> DataFrame:
    return rows.withColumn("route", F.when(F.col("reason").isNull(), ROWS).otherwise(QUARANTINE))


def _when_rejected(name: str) -> Column:
    return F.when(F.col("reason").isNotNull(), F.col(name))


def _event_date() -> Column:
    return F.col("event_time").cast("date")


def ingest(topic: DataFrame, layout: Layout, trigger: dict | None = None, **hooks) -> Job:
    """Topic messages to the raw layer and its quarantine, by message date.

    The default trigger drains the topic; FOLLOW keeps going in small batches.
    """

    def transform(batch: DataFrame) -> DataFrame:
        rows = _split(messages.decode(batch))
        return rows.withColumns(
            {"raw_value": _when_rejected("raw_value"), "ingest_date": F.to_date("timestamp")}
        ).drop("timestamp")

    return _start(
        topic.sparkSession, topic, layout, "ingest", "bronze", transform,
        {"bronze_count": ROWS}, "messages",
        date="ingest_date", trigger=trigger, **hooks,
    )


def bronze_to_silver(spark: SparkSession, layout: Layout, **hooks) -> Job:
    def transform(batch: DataFrame) -> DataFrame:
        rows = _split(silver.classify(batch))
        return rows.withColumns(
            {"raw_event_time": _when_rejected("raw_event_time"), "event_date": _event_date()}
        )

    return _start(
        spark, _Source("bronze", _BRONZE_READ), layout, "bronze_to_silver", "silver", transform,
        {"silver_count": ROWS}, "bronze_count", watermark=True, **hooks,
    )


def silver_to_gold(spark: SparkSession, layout: Layout, **hooks) -> Job:
    """Both gold outputs in one write: read once, committed together. The watermark is that of all rows read."""

    def transform(batch: DataFrame) -> DataFrame:
        return gold.routed(batch, "source_file").withColumn("event_date", _event_date())

    counts = {"gold_page_views_count": gold.PAGE_VIEWS, "gold_product_events_count": gold.PRODUCT_EVENTS}
    source = _Source("silver", _SILVER_READ, marks_read=True)
    return _start(
        spark, source, layout, "silver_to_gold", "gold", transform, counts, "silver_count", watermark=True, **hooks
    )


def load_mart(spark: SparkSession, layout: Layout, table: str, **hooks) -> Job:
    """One gold output to its mart, clustered by date, sorted and indexed by the mart's lookup key."""
    row, _, target, sort_key, counter = _MARTS[table]

    def transform(batch: DataFrame) -> DataFrame:
        rows = _split(marts.classify(batch, table, None, "source_file"))
        return marts.clustered(rows.withColumn("event_date", _event_date()), "route", "event_date", sort_key=sort_key)

    return _start(
        spark, _Source(table, row), layout, f"load_{target}", target, transform,
        {counter: ROWS}, "gold_rows",
        options=layers.lookup_options(sort_key), key=sort_key, **hooks,
    )


def roll_up(
    spark: SparkSession, layout: Layout, table: str, trigger: dict | None = None,
    after_write: Callable[[int], None] | None = None,
) -> Job:
    """States of a mart's new batches, for the reports of `rollups`; once for each batch of the mart.

    Follows the mart's commit log, as the hops do theirs. Start it before the mart's log is compacted for the first time;
    later compactions leave it the entries it has not read.
    """
    _, row, target, _, _ = _MARTS[table]
    source, root, job = layout.layer(target), layout.layer(f"{target}_states"), f"roll_up_{target}"
    counters = Counters()

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        writer = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        entry = layers.published(session, root, writer, batch_id)
        if entry is None:
            rows = layers.read_routes(session, source, row, batch, ROWS)
            entry = layers.publish_batch(
                rollups.STATES[table](rows), root, writer, batch_id, ["route"], batch.select("entry")
            )
        if after_write:
            after_write(batch_id)
        made = layers.read_entry(session, root, entry).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("states"))
        counters.batches.append({"batch_id": batch_id} | made.first().asDict())

    query = (
        layers.stream_commits(spark, source, layout.max_batches_per_trigger)
        .writeStream.queryName(job)
        .option("checkpointLocation", checkpoint(layout, job))
        .trigger(**(trigger or DRAIN))
        .foreachBatch(write)
        .start()
    )
    return query, counters


def read_states(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """The states that `roll_up` has made of a mart; a filter on `route`, the kind, prunes folders."""
    root = layout.layer(f"{_MARTS[table][2]}_states")
    return layers.read_all_routes(spark, root, rollups.STATE).select(*names(rollups.STATE), "route")


def load_marts(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Both marts, and the loader's six counters: rows, files and skipped files of each."""
    done: dict[str, int] = {}
    for table, name in ((gold.PAGE_VIEWS, "page_view"), (gold.PRODUCT_EVENTS, "product_event")):
        counters = finish(load_mart(spark, layout, table))
        done |= {
            f"inserted_{name}s": counters.total(_MARTS[table][4]),
            f"{name}_files": counters.total("files"),
            f"skipped_{name}_files": counters.skipped_files,
        }
    return done


def finish(job: Job) -> Counters:
    """Wait for a draining job; its failure is raised here."""
    query, counters = job
    query.awaitTermination()
    return counters


def _log_run(spark: SparkSession, layout: Layout, run_id: str, status: str, **values) -> None:
    now = _now()
    row = {"run_id": run_id, "status": status, "at": now, "seq": _micros(now), **values}
    line = spark.createDataFrame([tuple(row.get(n) for n in names(RUN_LOG))], RUN_LOG)
    folder = layers.batch_folder(layout.layer("runs"), run_id, _micros(now))
    line.coalesce(1).write.mode("overwrite").parquet(folder)


def run_full(spark: SparkSession, layout: Layout, run_id: str | None = None) -> dict[str, int]:
    """All hops from the raw layer to the marts, in order, with a run record around them.

    One run at a time: `leases.LeaseHeld` is raised while another is active, and a run without a sign of life for the
    lease's time may be taken over; it cannot commit after that. A failing hop marks the run FAILED and is raised;
    later hops do not start.
    """
    run_id = run_id or _now().strftime("%Y%m%dT%H%M%S%f")
    with leased(spark, layout, "run", run_id) as lease:
        return _run_hops(spark, layout, run_id, lease)


def _run_hops(spark: SparkSession, layout: Layout, run_id: str, lease: leases.Lease) -> dict[str, int]:
    _log_run(spark, layout, run_id, runs.RUNNING)
    hops = (
        lambda: bronze_to_silver(spark, layout, lease=lease),
        lambda: silver_to_gold(spark, layout, lease=lease),
        lambda: load_mart(spark, layout, gold.PAGE_VIEWS, lease=lease),
        lambda: load_mart(spark, layout, gold.PRODUCT_EVENTS, lease=lease),
    )
    done = dict.fromkeys(RUN_COUNTERS, 0)
    try:
        for hop in hops:
            counters = finish(hop())
            # silver_count of the second hop, rows read, replaces the first hop's rows written
            done |= {n: counters.total(n) for n in RUN_COUNTERS if any(n in b for b in counters.batches)}
    except Exception as error:
        _log_run(spark, layout, run_id, runs.FAILED, error_message=str(error)[:500])
        raise
    _log_run(spark, layout, run_id, runs.SUCCESS, **done)
    return done


def read_mart(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """Mart rows and their event_date, a filter on which prunes folders."""
    _, row, target, _, _ = _MARTS[table]
    rows = layers.read_layer(spark, layout.layer(target), row, ROWS, "event_date")
    return rows.select(*names(row), "event_date")


def _or_unknown(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(True))


def lookup(
    spark: SparkSession,
    layout: Layout,
    table: str,
    key: str,
    since: datetime | None = None,
    before: datetime | None = None,
) -> DataFrame:
    """The mart rows of one lookup key (user of page views, product of product events), with event times from `since` on and
    below `before` (UTC wall clocks, as the mart has them).

    The commit entries say which parts of the keys and which times each file has, so files are chosen before any is
    listed or opened: about one part in `functions.KEY_PARTS` of a large mart. Files of entries that do not say are read.
    """
    _, row, target, sort_key, _ = _MARTS[table]
    root = layout.layer(target)
    rows, lines = F.col(sort_key) == F.lit(key), _or_unknown(F.array_contains("parts", key_part(F.lit(key))))
    for bound, last, test in ((since, "last_time", Column.__ge__), (before, "first_time", Column.__lt__)):
        if bound is not None:
            at = F.lit(bound.isoformat(" ")).cast("timestamp_ntz")
            rows &= test(F.col("event_time"), at)
            lines &= _or_unknown(test(F.col(last).cast("timestamp_ntz"), at))
    chosen = layers.read_entries(spark, root).filter((F.col("route") == ROWS) & lines)
    return layers.read_files(spark, root, row, chosen, "event_date").filter(rows).select(*names(row), "event_date")


def stats(spark: SparkSession, layout: Layout) -> DataFrame:
    """Rows and files per active layer; zero for those that are empty or not there yet.

    Sums what the entries say of the files whose tasks are not done; no data file is listed or opened.
    """
    tasks = ledger.current_tasks(read_log(spark, layout, "tasks")).filter(F.col("status") == ledger.DONE)
    counts = []
    for layer, (folder, route) in FILES.items():
        lines = layers.read_entries(spark, layout.layer(folder)).filter(F.col("route") == route)
        gone = tasks.filter(F.col("layer") == layer).select(F.col("partition_key").alias("file"))
        active = lines.join(gone, "file", "left_anti")
        counts.append(active.select(F.lit(layer).alias("layer"), F.col("file").alias("object_name"), "rows"))
    return monitoring.layer_stats(*counts, layers=(*FILES, "gold"))


def _routes(spark: SparkSession, layout: Layout) -> DataFrame:
    rows = [(ledger.DATASET, n, layout.layer(FILES[n][0]), layout.archive(n)) for n in FILES]
    return spark.createDataFrame(rows, "dataset string, layer string, source string, archive string")


def _move_folder(spark: SparkSession, source: str, target: str) -> str | None:
    """Move a folder whose files may be there already, as a whole or in part; what went wrong, or None.

    As a whole where nothing is there yet; else file by file, where one of the same size is not moved again.
    """
    fs, old = files.file_system(spark, source)
    to_fs, new = files.file_system(spark, target)
    if not fs.exists(old):
        return None
    same = fs.getUri().equals(to_fs.getUri())
    try:
        if same and not to_fs.exists(new):
            to_fs.mkdirs(new.getParent())
            if fs.rename(old, new) and not fs.exists(old):
                return None
        base, found, left = len(old.toUri().getPath()) + 1, fs.listFiles(old, True), 0
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        while found.hasNext():
            status = found.next()
            _, there = files.file_system(spark, f"{target}/{status.getPath().toUri().getPath()[base:]}")
            if not to_fs.exists(there) or to_fs.getFileStatus(there).getLen() != status.getLen():
                to_fs.delete(there, False)
                to_fs.mkdirs(there.getParent())
                if same:
                    fs.rename(status.getPath(), there)
                else:
                    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, status.getPath(), to_fs, there, False, True, conf)
            arrived = to_fs.exists(there) and to_fs.getFileStatus(there).getLen() == status.getLen()
            left += not arrived
        if left:
            return f"{left} files did not arrive in {target}"
        fs.delete(old, True)
        return None
    except Exception as error:
        return f"moving {source}: {error}"


def _move(spark: SparkSession, plan: DataFrame) -> DataFrame:
    """Move the batch folders of the planned files' routes; a hop reads a route of a batch as a whole, so all its
    files are due together. Returns `source, folder, failure` of those that failed.

    Moves change names, not data, on a file system (an object store copies on its side), so a few threads of the
    driver do them; the folders are streamed, one for each batch and route.
    """
    due = plan.filter(F.col("error").isNull()).select("source", "archive", _folder_of("partition_key"))
    due = due.filter("folder <> ''").distinct()
    failed: list[tuple[str, str, str]] = []

    def move(r) -> None:
        source = f"{r['source'].rstrip('/')}/{r['folder']}"
        error = _move_folder(spark, source, f"{r['archive'].rstrip('/')}/{r['folder']}")
        if error:
            failed.append((r["source"], r["folder"], error))

    with ThreadPoolExecutor(_MOVERS) as pool:
        some: list = []
        for r in due.toLocalIterator():
            some.append(r)
            if len(some) == 64 * _MOVERS:
                list(pool.map(move, some))
                some = []
                if len(failed) > _MOST_FAILURES:
                    raise OSError(f"{len(failed)} folders could not be moved, such as {failed[0][1]}: {failed[0][2]}")
        list(pool.map(move, some))
    return spark.createDataFrame(failed, "source string, folder string, failure string")


def _folder_of(key: str) -> Column:
    return F.regexp_extract(key, r"\A(writer=[^/]+/batch_id=[^/]+/route=[^/]+)/", 1).alias("folder")


def due_tasks(spark: SparkSession, layout: Layout) -> DataFrame:
    """The tasks whose files no hop will read again: those of batches that their hop's checkpoint has committed.

    A batch hands its files over before its checkpoint commits it. If it stops in between it is replayed and reads
    them once more, so until then they stay where they are.
    """
    # Before the log: a batch that is committed in between has its tasks wait for the next run.
    fence = committed(spark, layout)
    log = read_log(spark, layout, "tasks")
    # One row for each hop.
    open_batches = log.join(F.broadcast(fence), "writer").filter(F.col("batch_id") > F.col("committed"))
    return ledger.current_tasks(log).join(open_batches.select(*ledger.TASK_KEY).distinct(), list(ledger.TASK_KEY), "left_anti")


def settle_archive(
    spark: SparkSession, layout: Layout, limit: int | None = None, routes: DataFrame | None = None
) -> DataFrame:
    """Archive the files of all open tasks that are due and settle the tasks.

    A file found in the archive, or in neither folder, is done; one still active stays open. A task without a route, or
    whose files could not be moved, fails with that error and is tried again while it has attempts. Appends to the
    task log and returns the report. `limit` takes only so many tasks, those longest untouched. One run at a time.
    """
    if not layout.archive_root:
        raise ValueError("the layout has no archive_root")
    with leased(spark, layout, "archive", "settle_archive"):
        return _settle(spark, layout, limit, routes)


def _settle(spark: SparkSession, layout: Layout, limit: int | None, routes: DataFrame | None) -> DataFrame:
    tasks = due_tasks(spark, layout)
    now = _now()
    seq = _micros(now)

    def kept(rows: DataFrame, name: str) -> DataFrame:
        # Written down once: folders and listings move on while we look.
        folder = layers.batch_folder(layout.layer(name), "archive", seq)
        rows.write.mode("overwrite").parquet(folder)
        return spark.read.schema(rows.schema).parquet(folder)

    plan = kept(archive.archive_plan(tasks, routes or _routes(spark, layout), limit), "archive_plans")
    failures = F.broadcast(_move(spark, plan))
    plan = plan.withColumn("folder", _folder_of("partition_key")).join(failures, ["source", "folder"], "left")
    plan = plan.withColumn("error", F.coalesce("error", "failure"))

    def listing(archived: bool) -> DataFrame:
        found = None
        for layer, (folder, _) in FILES.items():
            where = layout.archive(layer) if archived else layout.layer(folder)
            files = layers.list_files(spark, where).withColumn("layer", F.lit(layer))
            found = files if found is None else found.unionByName(files)
        return found

    outcomes = kept(archive.archive_outcomes(plan, listing(True), listing(False)), "archive_outcomes")

    def requests(to_status: Column, order: int) -> DataFrame:
        return outcomes.filter("outcome <> 'waiting'").select(
            *ledger.TASK_KEY, F.lit(order).alias("request_id"), to_status.alias("to_status"), "error"
        )

    claimed, _ = ledger.apply_transitions(
        tasks, requests(F.lit(ledger.IN_PROGRESS), 0), F.lit(now), F.lit(seq)
    )
    end = F.when(F.col("outcome") == "failed", ledger.FAILED).otherwise(ledger.DONE)
    ended, _ = ledger.apply_transitions(claimed, requests(end, 1), F.lit(now), F.lit(seq + 1))
    folder = layers.batch_folder(layout.layer("tasks"), "archive", seq)
    claimed.unionByName(ended).write.mode("overwrite").parquet(folder)
    return archive.archive_report(outcomes)


def _batch_of(entry: Column) -> tuple[Column, Column]:
    """Query id and batch in the name of an entry or a batch folder's writer and number."""
    return F.regexp_extract(entry, r"\A([^.]+?)(?:\.\d+)?-(\d+)\z", 1), F.regexp_extract(
        entry, r"-(\d+)\z", 1
    ).try_cast("bigint")


def _settled_entries(lines: DataFrame, fence: DataFrame) -> DataFrame:
    """The lines of entries whose batch the checkpoint of its hop has committed."""
    writer, batch = _batch_of(F.col("entry"))
    marked = lines.withColumns({"writer": writer, "batch": batch})
    return marked.join(F.broadcast(fence.drop("job")), "writer").filter("batch <= committed").drop("writer", "batch", "committed")


def compact(spark: SparkSession, layout: Layout, least: int = 16) -> dict[str, int]:
    """Keep old commit entries and task states in levelled snapshots; how many parts of each log went there.

    An entry goes when its own batch is committed and every hop that reads the layer has committed a batch that read it,
    so no stream misses one. Of tasks, every state that a newer one has replaced goes for good. Logs with fewer than
    `least` such parts are left alone. One compaction at a time.
    """
    with leased(spark, layout, "compact", "compact") as lease:
        fence = committed(spark, layout)
        done = {}
        for folder in WRITERS:
            root = layout.layer(folder)
            if not layers.exists(spark, root):
                continue
            lines = layers.read_entries(spark, root)
            kept = manifests.read(spark, root, layers.ENTRY)
            if kept is not None:
                lines = lines.join(kept.select("entry").distinct(), "entry", "left_anti").select(*names(layers.ENTRY))
            fresh = _settled_entries(lines, fence)
            asked = tuple(r for r in OPTIONAL_READERS.get(folder, ()) if layers.exists(spark, checkpoint(layout, WRITERS[r])))
            for reader in (*READERS.get(folder, ()), *asked):
                read = _settled_entries(layers.read_entries(spark, layout.layer(reader)), fence)
                seen = read.filter(F.col("source").isNotNull()).select(F.col("source").alias("entry")).distinct()
                fresh = fresh.join(seen, "entry", "left_semi")
            entries = [r["entry"] for r in fresh.select("entry").distinct().collect()]
            if len(entries) >= least:
                parts = [f"_commits/{e}.json" for e in entries]
                manifests.add(root, fresh.select(*names(layers.ENTRY)), parts, lambda rows: rows.coalesce(1), lease.check)
                done[folder] = len(entries)
        done |= _compact_tasks(spark, layout, fence, least, lease)
        return done


def _compact_tasks(spark: SparkSession, layout: Layout, fence: DataFrame, least: int, lease: leases.Lease) -> dict[str, int]:
    root = layout.layer("tasks")
    if not layers.exists(spark, root):
        return {}
    _, manifest = manifests.current(spark, root)
    newest = {r["writer"]: r["committed"] for r in fence.collect()}
    parts = []
    for writer in files.names(spark, root):
        if writer.startswith("writer="):
            name = writer.split("=", 1)[1]
            batches = files.names(spark, f"{root}/{writer}")
            old = [b for b in batches if b.startswith("batch_id=") and int(b.split("=", 1)[1]) <= newest.get(name, 1 << 62)]
            parts += [f"{writer}/{b}" for b in old]
    parts = sorted(set(parts) - set(manifest["stale"]))
    if len(parts) < least:
        return {}
    fresh = spark.read.schema(TASK_LOG).parquet(*(f"{root}/{p}" for p in parts))
    manifests.add(root, fresh, parts, lambda rows: ledger.current_tasks(rows).select(*names(TASK_LOG)), lease.check)
    return {"tasks": len(parts)}
