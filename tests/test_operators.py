"""Layer, mart, state and report operators on small frames with known answers."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from eventlayers import schemas
from eventlayers.operators import (
    analytics,
    archive,
    gold,
    ledger,
    marts,
    monitoring,
    runs,
    silver,
    star,
    watermarks,
)

NOW = datetime(2026, 5, 17, 12, tzinfo=timezone.utc)


def frame(spark, schema, *rows):
    return spark.createDataFrame([tuple(r.get(n) for n in schemas.names(schema)) for r in rows], schema)


def raw(**changes):
    row = {
        "event_time": "2026-05-17T12:00:00+00:00",
        "session_id": "s1",
        "user_id": "u1",
        "event_type": "page_view",
        "page_url": "https://shop.example.com/category/components/brakes?x=1",
        "extra": ("A", 40, None, None),
    }
    return row | changes


# --- raw to cleaned ------------------------------------------------------------------------


def test_bronze_to_silver(spark):
    row = silver.bronze_to_silver(frame(spark, schemas.BRONZE, raw())).first().asDict()
    assert list(row) == schemas.names(schemas.SILVER)
    assert row["event_time"] == datetime(2026, 5, 17, 12)
    assert row["page_host"] == "shop.example.com"
    assert row["page_path"] == "/category/components/brakes"
    assert (row["page_section"], row["page_category"], row["page_item"]) == ("category", "components", "brakes")
    assert (row["ab_group"], row["scroll_depth"]) == ("A", 40)
    assert all(row[c] is None for c in ("country", "city", "device_type", "browser_name"))


def test_bad_rows_are_kept_apart_with_their_reason(spark):
    rows = frame(
        spark, schemas.BRONZE, raw(), raw(event_time="soon"), raw(event_time=None), raw(page_url=None),
        raw(page_url="https://[x/"), raw(extra=None), raw(page_url=""),
    )
    assert silver.bronze_to_silver(rows).count() == 2
    rejects = silver.silver_rejects(rows).collect()
    assert sorted(r.reason for r in rejects) == ["bad_event_time"] * 2 + ["bad_url"] * 2 + ["null_extra"]
    assert "soon" in {r.raw_event_time for r in rejects}
    with pytest.raises(Exception, match="bad_event_time|bad_url|null_extra"):
        silver.bronze_to_silver(rows, mode="failfast").collect()
    with pytest.raises(ValueError):
        silver.bronze_to_silver(rows, mode="other")
    assert silver.bronze_to_silver(frame(spark, schemas.BRONZE, raw()), mode="failfast").count() == 1


# --- gold ----------------------------------------------------------------------------------


def silver_rows(spark):
    base = {"event_time": datetime(2026, 5, 17, 12), "session_id": "s", "user_id": "u", "event_type": "page_view"}
    shop = "https://shop.example.com"
    return frame(
        spark,
        schemas.SILVER,
        base | {"page_url": f"{shop}/home", "scroll_depth": 10},
        base | {"page_url": f"{shop}/product/1", "product_id": "p1", "price": 2.0, "event_type": "add_to_cart"},
        base | {"page_url": f"{shop}/checkout/success", "product_id": "p1", "price": 3.0, "event_type": "purchase"},
        base | {"page_url": f"{shop}/product/2"},
        base | {"page_url": f"{shop}/search?q=/product/z"},
        base | {"page_url": None},
        base | {"page_url": "", "product_id": " NaN "},
    )


def test_gold_outputs_overlap_and_leave_rows_out(spark):
    rows = silver_rows(spark)
    assert gold.page_views(rows).count() == 4
    assert gold.product_events(rows).count() == 2


def test_routed_equals_both_filters(spark):
    rows = silver_rows(spark)
    routed = gold.routed(rows)
    for route, output in ((gold.PAGE_VIEWS, gold.page_views(rows)), (gold.PRODUCT_EVENTS, gold.product_events(rows))):
        mine = routed.filter(F.col("route") == route)
        assert sorted(map(str, mine.select(*output.columns).collect())) == sorted(map(str, output.collect()))
    foreign = routed.filter(F.col("route") == gold.PAGE_VIEWS).select("product_id", "price").distinct().collect()
    assert [tuple(r) for r in foreign] == [(None, None)]


# --- marts ---------------------------------------------------------------------------------


def test_mart_refuses_rows_instead_of_cutting_them(spark):
    base = {"event_time": datetime(2026, 5, 17), "session_id": "s", "user_id": "u", "product_id": "p", "page_url": "x"}
    rows = frame(
        spark, schemas.GOLD_PRODUCT_EVENT, base | {"price": 1.005}, base | {"price": float("nan")},
        base | {"price": 1e9}, base | {"session_id": None}, base | {"user_id": "u" * 201},
        base | {"ab_group": "g" * 51}, base | {"product_id": None}, base | {"user_id": None},
    )
    kept = marts.mart_rows(rows, gold.PRODUCT_EVENTS, F.lit(NOW)).collect()
    assert sorted(str(r.price) for r in kept) == ["1.01", "None", "None"]
    assert {r.created_at.astimezone(timezone.utc) for r in kept} == {NOW}
    assert sorted(r.reason for r in marts.mart_rejects(rows, gold.PRODUCT_EVENTS).collect()) == [
        "null:product_id", "null:session_id", "price_overflow", "too_long:ab_group", "too_long:user_id",
    ]


# --- analytics -----------------------------------------------------------------------------


def views(spark, *rows):
    base = {"event_time": datetime(2026, 5, 17), "session_id": "s", "user_id": "u", "page_url": "a"}
    return frame(spark, schemas.GOLD_PAGE_VIEW, *(base | r for r in rows))


def products(spark, *rows):
    base = {"event_time": datetime(2026, 5, 17), "session_id": "s", "user_id": "u", "page_url": "a"}
    return frame(spark, schemas.GOLD_PRODUCT_EVENT, *(base | r for r in rows))


def test_top_landing_pages(spark):
    rows = views(spark, {"scroll_depth": 29}, {"scroll_depth": 30}, {}, {"page_url": "b"}, {"page_url": "c"})
    got = [tuple(r) for r in analytics.top_landing_pages(rows, limit=2).collect()]
    assert got == [("a", 3, 2, 2 / 3), ("b", 1, 1, 1.0)]


def test_top_products_unpriced_last_as_zero(spark):
    rows = products(
        spark, {"product_id": "a"}, {"product_id": "b", "price": 1.5}, {"product_id": "b", "price": 2.0},
        {"product_id": "c", "price": -1.0}, {"product_id": "NaN", "price": 99.0}, {"product_id": None},
    )
    assert [tuple(r) for r in analytics.top_products(rows).collect()] == [("b", 2, 3.5), ("c", 1, -1.0), ("a", 1, 0.0)]


def test_ab_summary_keeps_groups_with_views_only(spark):
    pv = views(spark, {"ab_group": "A"}, {"ab_group": "A"}, {"ab_group": "B"}, {})
    pe = products(
        spark, {"product_id": "p", "ab_group": "A"}, {"product_id": "p", "ab_group": "A", "session_id": None},
        {"product_id": "p", "ab_group": "C"},
    )
    assert [tuple(r) for r in analytics.ab_test_summary(pv, pe).collect()] == [("A", 2, 1, 2), ("B", 1, 0, 0)]


def test_user_sessions_paging_and_total(spark):
    rows = views(
        spark, {"session_id": "a", "event_time": datetime(2026, 1, 1)}, {"session_id": "a", "event_time": datetime(2026, 1, 3)},
        {"session_id": "b", "event_time": datetime(2026, 1, 2)}, {"session_id": None}, {"session_id": "x", "user_id": "other"},
    )
    page = analytics.user_sessions(rows, "u", skip=1, limit=2).collect()
    assert [(r.session_id, r.page_views) for r in page] == [("b", 1), ("a", 2)]
    assert analytics.user_total_sessions(rows, "u").first().total_sessions == 3
    assert analytics.user_total_sessions(rows, "nobody").first().total_sessions == 0


@pytest.mark.parametrize("limit", [0, 101, -1])
def test_limits_are_checked_early(spark, limit):
    rows = views(spark, {})
    for call in (analytics.top_landing_pages, analytics.top_products):
        with pytest.raises(ValueError):
            call(rows, limit)
    with pytest.raises(ValueError):
        analytics.user_sessions(rows, "u", limit=limit)
    with pytest.raises(ValueError):
        analytics.user_sessions(rows, "u", skip=-1)


# --- task log ------------------------------------------------------------------------------


def task(key="f1", status=ledger.PENDING, attempts=0, seq=1, layer="bronze", **more):
    return {
        "event_type": "ARCHIVE", "dataset": "web_events", "layer": layer, "partition_key": key, "status": status,
        "attempts": attempts, "created_at": NOW, "updated_at": NOW, "seq": seq,
    } | more


def log(spark, *rows):
    return frame(spark, schemas.TASK_LOG, *rows)


def names(df, column="partition_key"):
    return sorted(r[column] for r in df.collect())


def test_unprocessed_files_of_a_layer(spark):
    """A name that begins like a handed-over one, one handed over for another data set, and one listed twice."""
    listed = ["lake/a", "lake/a.1", "lake/b", "lake/c", "lake/c"]
    found = spark.createDataFrame([(n,) for n in listed], "object_name string")
    other = task("lake/b")
    tasks = log(spark, task("lake/a"), task("lake/c", layer="silver")).unionByName(
        log(spark, other).withColumn("dataset", F.lit("other_events"))
    )
    left = names(ledger.unprocessed_files(found, tasks, "bronze"), "object_name")
    assert left == ["lake/a.1", "lake/b", "lake/c", "lake/c"]
    assert tuple(ledger.file_progress(found, tasks, "bronze").first()) == (5, 1, 4)


def test_existing_keys(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("a",)], "partition_key string")
    tasks = log(spark, task("a"), task("a", ledger.DONE, seq=2), task("b", layer="silver"))
    assert names(ledger.existing_keys(tasks, keys, "web_events", "bronze")) == ["a"]
    assert ledger.existing_keys(tasks, keys.limit(0), "web_events", "bronze").count() == 0


def test_enqueue_is_idempotent(spark):
    keys = spark.createDataFrame([("web_events", "bronze", k) for k in "aab"], "dataset string, layer string, partition_key string")
    new = ledger.enqueue(log(spark, task("b", ledger.DONE)), keys, F.lit(NOW), F.lit(9))
    row = new.collect()
    assert [(r.partition_key, r.status, r.attempts, r.seq) for r in row] == [("a", "PENDING", 0, 9)]
    assert new.dtypes == log(spark).dtypes
    again = ledger.enqueue(log(spark, task("b", ledger.DONE)).unionByName(new), keys, F.lit(NOW), F.lit(10))
    assert again.count() == 0


def test_current_state_and_pending_order(spark):
    rows = log(
        spark, task("a", seq=1), task("a", ledger.DONE, 1, seq=3), task("a", ledger.IN_PROGRESS, 1, seq=2),
        task("b", ledger.FAILED, 4, seq=4, updated_at=datetime(2026, 5, 16)), task("c", ledger.FAILED, 5, seq=5),
        task("d", seq=6), task("e", ledger.IN_PROGRESS, 1, seq=7),
    )
    tasks = ledger.current_tasks(rows)
    assert {r.partition_key: r.status for r in tasks.collect()}["a"] == "DONE"
    assert [r.partition_key for r in ledger.pending_tasks(tasks).collect()] == ["b", "d"]
    assert [r.partition_key for r in ledger.pending_tasks(tasks, layer="silver").collect()] == []
    assert [r.partition_key for r in ledger.pending_tasks(tasks, event_type="ARCHIVE", limit=1).collect()] == ["b"]
    assert [r.partition_key for r in ledger.latest_tasks(tasks, limit=2).collect()] == ["e", "d"]
    counts = {r.status: r.tasks_count for r in ledger.status_counts(tasks).collect()}
    assert counts == {"PENDING": 1, "IN_PROGRESS": 1, "DONE": 1, "FAILED": 2, "TOTAL": 5}


def test_status_counts_of_no_tasks(spark):
    counts = {r.status: r.tasks_count for r in ledger.status_counts(log(spark)).collect()}
    assert counts == dict.fromkeys(("PENDING", "IN_PROGRESS", "DONE", "FAILED", "TOTAL"), 0)


def test_transitions(spark):
    tasks = log(
        spark, task("open"), task("spent", ledger.FAILED, 5), task("running", ledger.IN_PROGRESS, 2),
        task("breaking", ledger.IN_PROGRESS, 1), task("done", ledger.DONE, 1), task("raced"),
    )
    asked = [
        ("open", 1, "IN_PROGRESS", None), ("spent", 1, "IN_PROGRESS", None), ("running", 1, "DONE", None),
        ("breaking", 1, "FAILED", "e" * 600), ("done", 1, "DONE", None), ("raced", 1, "IN_PROGRESS", None),
        ("raced", 2, "IN_PROGRESS", None), ("unknown", 1, "DONE", None),
    ]
    requests = spark.createDataFrame(
        [("ARCHIVE", "web_events", "bronze", *a) for a in asked],
        "event_type string, dataset string, layer string, partition_key string, request_id int, to_status string, error string",
    )
    taken, refused = ledger.apply_transitions(tasks, requests, F.lit(NOW), F.lit(9))
    got = {r.partition_key: (r.status, r.attempts, r.last_error) for r in taken.collect()}
    assert got == {
        "open": ("IN_PROGRESS", 1, None), "running": ("DONE", 2, None), "breaking": ("FAILED", 1, "e" * 500),
        "raced": ("IN_PROGRESS", 1, None),
    }
    assert sorted((r.partition_key, r.request_id) for r in refused.collect()) == [
        ("done", 1), ("raced", 2), ("spent", 1), ("unknown", 1),
    ]


def test_archive_plan_and_report(spark):
    tasks = log(spark, *(task(k) for k in ("moved", "waiting", "gone")), task("odd", layer="lost"))
    plan = archive.archive_plan(tasks, archive.default_routes(spark, "root"))
    routes = {r.partition_key: (r.source, r.archive, r.error) for r in plan.collect()}
    assert routes["moved"] == ("root/bronze", "root/bronze-archive", None)
    assert routes["odd"] == (None, None, "no archive folder is set for web_events/lost")
    listing = "layer string, object_name string"
    outcomes = archive.archive_outcomes(
        plan, spark.createDataFrame([("bronze", "moved")], listing), spark.createDataFrame([("bronze", "waiting")], listing)
    )
    assert tuple(archive.archive_report(outcomes).first()) == (3, 1, 1, 1)


def test_retention_plan(spark):
    rows = [("bronze", "a", 5, 10, datetime(2026, 1, 1)), ("bronze", "b", 5, 10, datetime(2026, 2, 1))]
    files = spark.createDataFrame(rows, "layer string, object_name string, rows long, bytes long, modified_at timestamp")
    got = archive.retention_plan(files, datetime(2026, 1, 15)).first()
    assert (got.files, got.rows, got.bytes) == (1, 5, 10)


# --- watermarks and runs -------------------------------------------------------------------


def test_watermark_never_moves_back(spark):
    def mark(ts, id, seq, layer="x"):
        return {"dataset": "d", "layer": layer, "last_processed_ts": ts, "last_processed_id": id, "updated_at": NOW, "seq": seq}

    rows = frame(
        spark, schemas.WATERMARK_LOG, mark(datetime(2026, 1, 2), 7, 1), mark(datetime(2026, 1, 1), None, 2),
        mark(None, 5, 3), mark(None, None, 4), mark(None, None, 1, "y"),
    )
    got = {r.layer: (r.last_processed_ts, r.last_processed_id) for r in watermarks.current_watermarks(rows).collect()}
    assert got == {"x": (datetime(2026, 1, 2), 5), "y": (None, None)}


def test_run_history(spark):
    counts = dict.fromkeys(schemas.RUN_COUNTERS, 2)
    at = [datetime(2026, 1, 1, 0, 0, s, 500, tzinfo=timezone.utc) for s in (0, 1, 2)]
    rows = frame(
        spark,
        schemas.RUN_LOG,
        {"run_id": "1", "status": "RUNNING", "at": at[0], "seq": 1},
        {"run_id": "1", "status": "SUCCESS", "at": at[1], "seq": 2} | counts,
        {"run_id": "2", "status": "RUNNING", "at": at[1], "seq": 3},
        {"run_id": "2", "status": "FAILED", "at": at[2], "seq": 4, "error_message": "e" * 600},
        {"run_id": "3", "status": "RUNNING", "at": at[2], "seq": 5},
    )
    got = {r.run_id: r for r in runs.with_totals(runs.run_history(rows)).collect()}
    assert (got["1"].status, got["1"].gold_count, got["1"].loaded_count) == ("SUCCESS", 4, 4)
    assert str(got["1"].duration_seconds) == "1.000"
    assert (got["2"].status, len(got["2"].error_message), got["2"].bronze_count) == ("FAILED", 500, 0)
    assert (got["3"].status, got["3"].finished_at, got["3"].duration_seconds) == ("RUNNING", None, None)
    assert [r.run_id for r in runs.latest_runs(runs.run_history(rows), 2).collect()] == ["3", "2"]


# --- star ----------------------------------------------------------------------------------


def test_process_records(spark):
    u = "0f8fad5b-d9cb-469f-a165-70867728950e"
    v = "7c9e6679-7425-40de-944b-e07fc1f90ae7"
    records = spark.createDataFrame(
        [
            (1, 10, u, "2024-01-01T00:00:00", "view", None, "phone"),
            (2, 11, "{" + u.upper() + "}", "2024-01-01T00:00:01", "click", "firefox", "tablet"),
            (3, 12, "broken", "2024-01-01T00:00:02", "view", None, None),
            (4, 12, None, "2024-01-01T00:00:02", "view", None, None),
            (5, 13, "urn:uuid:" + v, "2024-01-01T00:00:03", "", "chrome", None),
        ],
        "n long, user_id long, session_id string, timestamp string, event_type string, browser string, device string",
    )
    users = spark.createDataFrame([(10,)], "user_id long")
    sessions = spark.createDataFrame([(v,)], "session_id string")
    got = star.process_records(records, users, sessions, F.col("n"), F.col("n"))
    assert sorted(r.user_id for r in got.users.collect()) == [11, 13]
    assert [tuple(r) for r in got.sessions.collect()] == [(u, 10, None, "phone")]
    assert sorted(tuple(r) for r in got.events.collect()) == [
        (1, u, 1704067200, "view"), (2, u, 1704067201, "click"), (5, v, 1704067203, ""),
    ]
    assert sorted((r.session_id or "", r.records) for r in star.skipped_sessions(got.rejects).collect()) == [("", 1), ("broken", 1)]
    assert star.skipped_count(got.rejects).first().skipped == 2


def test_event_key_of_scanned_files_is_stable(spark, tmp_path):
    spark.range(20).write.parquet(str(tmp_path / "x"))
    keys = [
        sorted(r.k for r in spark.read.parquet(str(tmp_path / "x")).select(star.file_event_key().alias("k")).collect())
        for _ in range(2)
    ]
    assert keys[0] == keys[1] and len(set(keys[0])) == 20


# --- monitoring and generator --------------------------------------------------------------


def test_layer_stats(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "object_name string")
    got = monitoring.layer_stats(
        *(monitoring.file_counts(rows, n) for n in ("bronze", "gold_page_views", "gold_product_events")),
        layers=("bronze", "silver"),
    )
    assert {r.layer: (r.files, r.rows) for r in got.collect()} == {
        "bronze": (2, 3), "gold_page_views": (2, 3), "gold_product_events": (2, 3), "gold": (4, 6),
        "silver": (0, 0),
    }


def test_a_users_rows_of_a_day_share_a_file(spark, tmp_path):
    days = F.date_add(F.lit("2026-05-17").cast("date"), (F.col("id") % 2).cast("int"))
    rows = spark.range(60_000).select(days.alias("day"), F.concat(F.lit("user-"), (F.col("id") % 997).cast("string")).alias("user_id"), F.sha2(F.col("id").cast("string"), 256).alias("page"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "1m")
    try:
        marts.clustered(rows, "day", sort_key="user_id").write.partitionBy("day").parquet(str(tmp_path / "mart"))
    finally:
        spark.conf.unset(size)
    mart = spark.read.parquet(str(tmp_path / "mart")).withColumn("file", F.col("_metadata.file_path"))
    files = {r.day: r.n for r in mart.groupBy("day").agg(F.count_distinct("file").alias("n")).collect()}
    assert all(n >= 2 for n in files.values())
    per_user = mart.groupBy("day", "user_id").agg(F.count_distinct("file").alias("n"))
    assert per_user.agg(F.max("n")).first()[0] == 1


# --- skew ----------------------------------------------------------------------------------


def test_one_key_with_a_third_of_all_rows(spark):
    """One page, product, user and session hold a third of the rows; nothing is lost or capped."""
    n = 30_000
    hot = F.col("id") % 3 == 0
    key = F.when(hot, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 1000).cast("string")))
    rows = spark.range(n).select(
        F.lit("2026-05-17 00:00:00").cast("timestamp_ntz").alias("event_time"), key.alias("session_id"),
        key.alias("user_id"), key.alias("page_url"), key.alias("product_id"), F.lit(1.5).alias("price"),
        F.lit("A").alias("ab_group"), (F.col("id") % 100).cast("int").alias("scroll_depth"), F.col("id"),
    )
    top = analytics.top_landing_pages(rows, 1).first()
    assert (top.page_url, top.page_views, top.bounces) == ("hot", 10_000, 3_000)
    assert tuple(analytics.top_products(rows, 1).first()) == ("hot", 10_000, 15_000.0)
    distinct = rows.select("session_id").distinct().count()
    assert tuple(analytics.ab_test_summary(rows, rows).first()) == ("A", n, distinct, n)
    assert analytics.user_sessions(rows, "hot").first().page_views == 10_000
    requests = rows.select(
        F.lit("ARCHIVE").alias("event_type"), F.lit("web_events").alias("dataset"), F.lit("bronze").alias("layer"),
        key.alias("partition_key"), F.col("id").alias("request_id"), F.lit("IN_PROGRESS").alias("to_status"),
        F.lit(None).cast("string").alias("error"),
    )
    taken, refused = ledger.apply_transitions(log(spark, task("hot")), requests, F.lit(NOW), F.lit(9))
    assert taken.count() == 1 and refused.count() == n - 1
