"""The checkpointed jobs: once and only once, through crashes, reruns and archiving."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventlayers import schemas
from eventlayers.operators import gold, ledger, marts, runs, silver, watermarks
from eventlayers.sources import layers, messages
from eventlayers.streaming import jobs

AS_OF = datetime(2026, 5, 17, 12)


def sessions(spark, n: int, start: int = 0):
    """Raw rows of `n` sessions of six events: views, a product page, and now and then a cart and a purchase."""
    step, no = F.col("step"), F.col("session_no")
    bought = (step == 5) & (no % 3 == 0)
    product = F.when((step == 4) | bought, F.concat(F.lit("p"), (no % 7).cast("string")))
    page = (
        F.when(bought, "/checkout/success").when(step == 4, F.concat(F.lit("/product/"), (no % 7).cast("string")))
        .when(step % 2 == 0, "/home").otherwise("/category/bikes/road?frame=carbon")
    )
    rows = spark.range(start, start + n).withColumnRenamed("id", "session_no").withColumn(
        "step", F.explode(F.sequence(F.lit(0), F.lit(5)))
    )
    at = F.timestamp_add("MINUTE", step - no * 40, F.lit(str(AS_OF)).cast("timestamp_ntz"))
    values = {
        "event_time": F.replace(at.cast("string"), F.lit(" "), F.lit("T")),
        "session_id": F.concat(F.lit("s"), no.cast("string")),
        "user_id": F.concat(F.lit("user-"), (no % 11).cast("string")),
        "event_type": F.when(bought, "purchase").when(step == 4, "add_to_cart").otherwise("page_view"),
        "page_url": F.concat(F.lit("https://shop.test"), page),
        "product_id": product,
        "price": F.when(product.isNotNull(), 9.5 + no),
        "extra": F.struct(
            F.when(no % 2 == 0, "A").otherwise("B").alias("ab_group"), (step * 15).cast("int").alias("scroll_depth"),
            F.lit(None).cast("string").alias("payment_method"), F.lit(None).cast("double").alias("basket_value"),
        ),
        "topic": F.lit("sessions_raw"), "partition": F.lit(0), "offset": no * 10 + step,
    }
    return rows.select(
        *(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.BRONZE), "session_no", "step"
    )


def send(spark, folder: Path, start: int, n: int, broken: int = 0, rows=None) -> None:
    """Messages of sessions, and some that are not JSON, as one more topic file."""
    rows = sessions(spark, n, start) if rows is None else rows
    sent = messages.encode(rows, "topic", "partition", "offset", F.lit(str(AS_OF)).cast("timestamp").alias("timestamp"))
    bad = sent.limit(broken).withColumns({"value": F.lit("{bad").cast("binary"), "offset": -F.col("offset") - 1})
    sent.unionByName(bad).select(*schemas.names(schemas.MESSAGE)).coalesce(1).write.mode("append").parquet(str(folder))


def topic(spark, folder: Path):
    return spark.readStream.schema(schemas.MESSAGE).parquet(str(folder))


def counts(spark, layout, names=("bronze", "silver", "gold", "mart_page_views", "mart_product_events")):
    return {
        n: spark.read.schema("route string").parquet(layout.layer(n)).groupBy("route").count().rdd.collectAsMap()
        for n in names
    }


def expected(rows):
    cleaned = silver.bronze_to_silver(rows)
    return gold.page_views(cleaned).count(), gold.product_events(cleaned).count()


def test_two_runs_load_everything_once(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "layers"), archive_root=str(tmp_path / "archive"))
    send(spark, tmp_path / "topic", 0, 40, broken=3)
    got = jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
    total = sessions(spark, 40).count()
    assert (got.total("messages"), got.total("bronze_count"), got.total("rejected")) == (total + 3, total, 3)

    first = jobs.run_full(spark, layout)
    views, products = expected(sessions(spark, 40))
    assert first == {
        "bronze_count": total, "silver_count": total, "gold_page_views_count": views,
        "gold_product_events_count": products, "loaded_page_views_count": views,
        "loaded_product_events_count": products,
    }

    # Nothing new: nothing is done again.
    assert set(jobs.run_full(spark, layout).values()) == {0}

    send(spark, tmp_path / "topic", 40, 25)
    jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
    jobs.run_full(spark, layout)
    all_views, all_products = expected(sessions(spark, 65))
    assert jobs.read_mart(spark, layout, gold.PAGE_VIEWS).count() == all_views
    assert jobs.read_mart(spark, layout, gold.PRODUCT_EVENTS).count() == all_products

    # Mart rows equal those of the batch operators.
    batch = marts.mart_rows(gold.page_views(silver.bronze_to_silver(sessions(spark, 65))), gold.PAGE_VIEWS)
    stream = jobs.read_mart(spark, layout, gold.PAGE_VIEWS).drop("event_date", "created_at")
    assert sorted(map(str, stream.collect())) == sorted(map(str, batch.drop("created_at").collect()))

    # Every source file has one task; watermark and run history are there.
    tasks = ledger.current_tasks(jobs.read_log(spark, layout, "tasks"))
    assert {r.status for r in tasks.collect()} == {"PENDING"}
    assert files_with_tasks(spark, layout) == committed_files(spark, layout)
    marks = {r.layer: r.last_processed_ts for r in watermarks.current_watermarks(jobs.read_log(spark, layout, "watermarks")).collect()}
    newest = silver.bronze_to_silver(sessions(spark, 65)).agg(F.max("event_time")).first()[0]
    assert marks == {"bronze_to_silver": newest, "silver_to_gold": newest}
    history = runs.run_history(jobs.read_log(spark, layout, "runs")).orderBy("started_at").collect()
    assert [r.status for r in history] == ["SUCCESS"] * 3
    assert (history[0].bronze_count, history[1].bronze_count) == (total, 0)
    assert history[0].duration_seconds > 0

    # All files are read, so all are archived, and their tasks settle as done.
    before = committed_files(spark, layout)
    report = jobs.settle_archive(spark, layout).first()
    assert (report.archived, report.failed, report.skipped) == (sum(map(len, before.values())), 0, 0)
    states = {r.status: r.tasks_count for r in ledger.status_counts(ledger.current_tasks(jobs.read_log(spark, layout, "tasks"))).collect()}
    assert states["DONE"] == states["TOTAL"] == report.archived
    assert jobs.settle_archive(spark, layout).first().taken == 0
    assert {r.layer: (r.files, r.rows) for r in jobs.stats(spark, layout).collect()} == dict.fromkeys(
        ("bronze", "silver", "gold_page_views", "gold_product_events", "gold"), (0, 0)
    )
    # What comes later goes on from there.
    send(spark, tmp_path / "topic", 65, 5)
    jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
    assert jobs.run_full(spark, layout)["silver_count"] == sessions(spark, 5).count()
    assert jobs.read_mart(spark, layout, gold.PAGE_VIEWS).count() == expected(sessions(spark, 70))[0]


def committed_files(spark, layout):
    out = {}
    for layer, (folder, route) in jobs.FILES.items():
        entries = spark.read.schema(layers.COMMIT).json(layers.commit_folder(layout.layer(folder)))
        out[layer] = {r.file for r in entries.filter(F.col("route") == route).collect()}
    return out


def files_with_tasks(spark, layout):
    out = {layer: set() for layer in jobs.FILES}
    for r in ledger.current_tasks(jobs.read_log(spark, layout, "tasks")).collect():
        out[r.layer].add(r.partition_key)
    return out


def test_files_without_output_get_tasks_and_move_the_watermark(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "layers"))
    rows = sessions(spark, 1).filter("step = 4").withColumn("product_id", F.lit(None).cast("string"))
    send(spark, tmp_path / "topic", 0, 1, rows=rows)
    jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
    done = jobs.run_full(spark, layout)
    assert (done["silver_count"], done["gold_page_views_count"], done["gold_product_events_count"]) == (1, 0, 0)
    tasks = files_with_tasks(spark, layout)
    assert len(tasks["silver"]) == len(tasks["bronze"]) == 1 and tasks == committed_files(spark, layout)
    marks = {r.layer: r.last_processed_ts for r in watermarks.current_watermarks(jobs.read_log(spark, layout, "watermarks")).collect()}
    assert marks["silver_to_gold"] == marks["bronze_to_silver"] == AS_OF.replace(minute=4)


def test_loader_counts_rows_files_and_skipped_files(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "layers"))
    for start in (0, 12):
        send(spark, tmp_path / "topic", start, 12)
        jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
        jobs.finish(jobs.bronze_to_silver(spark, layout))
        jobs.finish(jobs.silver_to_gold(spark, layout))
        before = {k: len(v) for k, v in files_with_tasks(spark, layout).items()}
        done = jobs.load_marts(spark, layout)
        views, products = expected(sessions(spark, 12, start))
        assert (done["inserted_page_views"], done["inserted_product_events"]) == (views, products)
        after = {k: len(v) for k, v in files_with_tasks(spark, layout).items()}
        for table, name in ((gold.PAGE_VIEWS, "page_view"), (gold.PRODUCT_EVENTS, "product_event")):
            assert done[f"skipped_{name}_files"] == before[table]
            assert done[f"{name}_files"] == after[table] - before[table] > 0
    again = jobs.load_marts(spark, layout)
    assert again["inserted_page_views"] == again["page_view_files"] == 0 and again["skipped_page_view_files"] == after[gold.PAGE_VIEWS]
    job = jobs.bronze_to_silver(spark, layout)
    assert jobs.finish(job).skipped_files == after["bronze"] > 0


def test_a_lake_that_is_not_there_yet(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "layers"), archive_root=str(tmp_path / "archive"))
    assert {(r.files, r.rows) for r in jobs.stats(spark, layout).collect()} == {(0, 0)}
    assert jobs.stats(spark, layout).count() == 5
    assert jobs.read_mart(spark, layout, gold.PAGE_VIEWS).count() == 0
    assert set(jobs.run_full(spark, layout).values()) == {0}
    assert jobs.settle_archive(spark, layout).first().taken == 0


def test_stuck_tasks_do_not_block_the_archive(spark, tmp_path):
    """Sixty tasks whose files stay where they are, and ten newer ones whose files are archived already."""
    layout = jobs.Layout(str(tmp_path / "layers"), archive_root=str(tmp_path / "archive"))
    tasks = []
    for k in range(70):
        name = f"writer=w/batch_id={k}/stuck.parquet" if k < 60 else f"writer=w/batch_id={k}/route=rows/x.parquet"
        where = Path(layout.layer("bronze") if k < 60 else layout.archive("bronze")) / name
        where.parent.mkdir(parents=True)
        where.write_bytes(b"x")
        at = datetime(2026, 1, 1 + k // 24, k % 24)
        tasks.append(("ARCHIVE", "web_events", "bronze", name, "PENDING", 0, at, None, at, at, k))
    spark.createDataFrame(tasks, schemas.TASK_LOG).write.parquet(layers.batch_folder(layout.layer("tasks"), "t", 0))
    report = jobs.settle_archive(spark, layout).first()
    assert (report.taken, report.archived, report.skipped) == (10, 10, 0)


class CrashOnce:
    def __init__(self):
        self.armed = True

    def __call__(self, batch_id):
        if self.armed:
            self.armed = False
            raise RuntimeError("crash after write")


def test_crash_between_write_and_commit_leaves_no_duplicates(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "layers"))
    send(spark, tmp_path / "topic", 0, 30, broken=2)
    starts = [
        lambda **h: jobs.ingest(topic(spark, tmp_path / "topic"), layout, **h),
        lambda **h: jobs.bronze_to_silver(spark, layout, **h),
        lambda **h: jobs.silver_to_gold(spark, layout, **h),
        lambda **h: jobs.load_mart(spark, layout, gold.PAGE_VIEWS, **h),
        lambda **h: jobs.load_mart(spark, layout, gold.PRODUCT_EVENTS, **h),
    ]
    targets = ("bronze", "silver", "gold", "mart_page_views", "mart_product_events")
    for start, target in zip(starts, targets):
        with pytest.raises(Exception, match="crash after write"):
            jobs.finish(start(after_write=CrashOnce()))
        before = sorted(Path(layout.layer(target)).rglob("*.parquet"))
        replayed = jobs.finish(start())
        # The replay leaves the published files alone, so no later hop reads them twice.
        assert before and sorted(Path(layout.layer(target)).rglob("*.parquet")) == before
        assert len(replayed.batches) == 1
    # Counters of a replay equal those of the run it completes.
    assert replayed.total("loaded_product_events_count") == expected(sessions(spark, 30))[1]
    total = sessions(spark, 30).count()
    views, products = expected(sessions(spark, 30))
    assert counts(spark, layout) == {
        "bronze": {"rows": total, "quarantine": 2},
        "silver": {"rows": total},
        "gold": {"gold_page_views": views, "gold_product_events": products},
        "mart_page_views": {"rows": views},
        "mart_product_events": {"rows": products},
    }
    log = jobs.read_log(spark, layout, "tasks")
    assert log.count() == ledger.current_tasks(log).count() == log.select("layer", "partition_key").distinct().count()
    assert jobs.read_log(spark, layout, "watermarks").count() == 2


def test_a_batch_without_entry_is_not_seen_and_written_again(spark, tmp_path, monkeypatch):
    """Crashes before the commit: with all files there and Spark's own marker, and with half of them."""
    layout = jobs.Layout(str(tmp_path / "layers"))
    send(spark, tmp_path / "topic", 0, 10)

    def crash(*_):
        raise RuntimeError("crash before the commit")

    for lose in (False, True):
        monkeypatch.setattr(layers, "commit", crash)
        with pytest.raises(Exception, match="crash before the commit"):
            jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
        monkeypatch.undo()
        files = sorted(Path(layout.layer("bronze")).glob("writer=*/**/*.parquet"))
        assert files and list(Path(layout.layer("bronze")).glob("writer=*/batch_id=*/_SUCCESS"))
        if lose:
            for f in files[::2]:
                f.unlink()
        rows = layers.read_layer(spark, layout.layer("bronze"), schemas.BRONZE, jobs.ROWS, "ingest_date")
        assert rows.count() == 0
        assert jobs.finish(jobs.bronze_to_silver(spark, layout)).total("bronze_count") == 0
    jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
    total = sessions(spark, 10).count()
    assert counts(spark, layout, ("bronze",)) == {"bronze": {"rows": total}}
    assert jobs.finish(jobs.bronze_to_silver(spark, layout)).total("silver_count") == total


def test_failed_hop_marks_the_run_failed(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "layers"))
    send(spark, tmp_path / "topic", 0, 5)
    jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
    file = next(Path(layout.layer("bronze")).glob("writer=*/batch_id=*/route=rows/ingest_date=*/*.parquet"))
    file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    file.write_bytes(b"not parquet")
    with pytest.raises(Exception, match="not a Parquet file|CANNOT_READ|FAILED_READ_FILE"):
        jobs.run_full(spark, layout, run_id="r1")
    row = runs.run_history(jobs.read_log(spark, layout, "runs")).first()
    assert (row.run_id, row.status, row.bronze_count) == ("r1", "FAILED", 0)
    assert row.error_message and row.finished_at
    assert not Path(layout.layer("silver")).exists() or counts(spark, layout, ("silver",)) == {"silver": {}}


def test_mart_files_are_sorted_by_lookup_key_and_pruned_by_date(spark, tmp_path):
    import pyarrow.parquet as pq

    layout = jobs.Layout(str(tmp_path / "layers"))
    send(spark, tmp_path / "topic", 0, 300)
    jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
    jobs.run_full(spark, layout)
    files = list(Path(layout.layer("mart_page_views")).rglob("*.parquet"))
    assert files
    for f in files:
        users = pq.read_table(f, partitioning=None)["user_id"].to_pylist()
        assert users == sorted(users)
    day = jobs.read_mart(spark, layout, gold.PAGE_VIEWS).filter("event_date = DATE'2026-05-17'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(route" in plan and "event_date" in plan.split("PartitionFilters")[1]
    assert 0 < day.count() < jobs.read_mart(spark, layout, gold.PAGE_VIEWS).count()


def test_follow_keeps_the_topic_up_to_date(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "layers"))
    send(spark, tmp_path / "topic", 0, 5)
    query, counters = jobs.ingest(topic(spark, tmp_path / "topic"), layout, jobs.FOLLOW)
    try:
        query.processAllAvailable()
        send(spark, tmp_path / "topic", 5, 5)
        query.processAllAvailable()
    finally:
        query.stop()
    assert counters.total("bronze_count") == sessions(spark, 10).count()
    assert len([b for b in counters.batches if b["messages"]]) == 2


def test_backlog_is_worked_off_in_steps(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "layers"), max_batches_per_trigger=1)
    for start in (0, 5, 10):
        send(spark, tmp_path / "topic", start, 5)
        jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
    got = jobs.finish(jobs.bronze_to_silver(spark, layout))
    assert len(got.batches) == 3 and got.total("silver_count") == sessions(spark, 15).count()
