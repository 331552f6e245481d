"""Reports from states against the reports from rows."""

import pytest
from test_streaming import CrashOnce, send, topic

from eventlayers.operators import analytics, gold, rollups
from eventlayers.streaming import jobs


def same(left, right):
    return sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


def check(views, products, v, p):
    assert same(rollups.page_stats(v), analytics.page_stats(views))
    assert same(rollups.product_stats(p), analytics.product_stats(products))
    assert same(analytics.first_products(rollups.product_stats(p), 3), analytics.top_products(products, 3))
    assert same(rollups.ab_test_summary(v, p), analytics.ab_test_summary(views, products))
    user = views.groupBy("user_id").count().orderBy("count", "user_id").first().user_id
    assert same(rollups.user_sessions(v, user, 1, 5), analytics.user_sessions(views, user, 1, 5))
    assert same(rollups.user_total_sessions(v, user), analytics.user_total_sessions(views, user))


def test_reports_after_added_batches_read_only_states(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "layers"))
    tables = (gold.PAGE_VIEWS, gold.PRODUCT_EVENTS)
    for k in range(3):
        send(spark, tmp_path / "topic", k * 15, 20)  # five sessions of each batch come again with the next
        jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
        jobs.run_full(spark, layout)
        for table in tables:
            if k == 1:
                with pytest.raises(Exception, match="crash after write"):
                    jobs.finish(jobs.roll_up(spark, layout, table, after_write=CrashOnce()))
            assert jobs.finish(jobs.roll_up(spark, layout, table)).total("states") > 0
    assert jobs.finish(jobs.roll_up(spark, layout, tables[0])).batches == []
    v, p = (jobs.read_states(spark, layout, t) for t in tables)
    views, products = (jobs.read_mart(spark, layout, t) for t in tables)
    check(views, products, v, p)
    check(views, products, rollups.merged(v), rollups.merged(p))
    near = rollups.ab_test_summary(v, p, approximate=True)
    assert same(near, rollups.ab_test_summary(v, p))  # few sessions: the sketch is exact
    for report in (rollups.page_stats(v), rollups.ab_test_summary(v, p)):
        assert report.inputFiles() and all("_states/" in f for f in report.inputFiles())


def test_compaction_waits_for_states(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "layers"))
    mart = "mart_page_views"
    for k in range(2):
        send(spark, tmp_path / "topic", k * 10, 10)
        jobs.finish(jobs.ingest(topic(spark, tmp_path / "topic"), layout))
        jobs.run_full(spark, layout)
        if k == 0:
            jobs.finish(jobs.roll_up(spark, layout, gold.PAGE_VIEWS))
    assert jobs.compact(spark, layout, least=1)[mart] == 1  # the second is not rolled up yet
    jobs.finish(jobs.roll_up(spark, layout, gold.PAGE_VIEWS))
    assert jobs.compact(spark, layout, least=1)[mart] == 1
    views = jobs.read_mart(spark, layout, gold.PAGE_VIEWS)
    assert same(rollups.page_stats(jobs.read_states(spark, layout, gold.PAGE_VIEWS)), analytics.page_stats(views))


def test_states_of_nothing_and_of_nulls(spark):
    views = spark.createDataFrame(
        [(None, None, None, None, None, None), ("u", None, None, "A", 10, "p")],
        "user_id string, session_id string, event_time timestamp_ntz, ab_group string, scroll_depth int, page_url string",
    )
    products = spark.createDataFrame(
        [(None, None, None, None), ("p", None, None, "A"), ("NaN", "s", None, "A")],
        "product_id string, session_id string, price decimal(10,2), ab_group string",
    )
    check(views.filter("user_id = 'u'"), products, rollups.view_states(views.filter("user_id = 'u'")), rollups.product_states(products))
    assert same(rollups.page_stats(rollups.view_states(views)), analytics.page_stats(views))
    check_empty = rollups.view_states(views.limit(0)), rollups.product_states(products.limit(0))
    assert rollups.ab_test_summary(*check_empty).count() == rollups.page_stats(check_empty[0]).count() == 0
