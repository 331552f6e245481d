"""The reports from partial aggregates: states of batches of mart rows, and their merge.

A state is an aggregate that can be added to others of its kind: counts, sums, bounds, a sketch of distinct sessions, and
the distinct pairs themselves for the exact answer. Reports read states only; their size follows the pages, products and
sessions of a batch, not its rows. Merging gives what `analytics` gives on the rows, except for `approximate` counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlayers.operators import analytics, gold

# Kinds of states. A kind is a folder, so a report reads no other.
PAGES, VIEW_GROUPS, USERS = "pages", "view_groups", "users"
PRODUCTS, PRODUCT_GROUPS, GROUP_SESSIONS = "products", "product_groups", "group_sessions"

STATE = T.StructType(
    [
        # Page, product, A/B group or user.
        T.StructField("key", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("bounces", T.LongType()),
        T.StructField("revenue", T.DecimalType(38, 2)),
        T.StructField("sessions", T.BinaryType()),
        T.StructField("first_time", T.TimestampNTZType()),
        T.StructField("last_time", T.TimestampNTZType()),
    ]
)


def _state(rows: DataFrame, kind: str) -> DataFrame:
    known = {f.name: F.col(f.name) if f.name in rows.columns else F.lit(None) for f in STATE}
    return rows.select(*(known[f.name].cast(f.dataType).alias(f.name) for f in STATE), F.lit(kind).alias("route"))


def _per(rows: DataFrame, by: list[str], **states: Column) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), *(c.alias(n) for n, c in states.items()))


def view_states(page_views: DataFrame) -> DataFrame:
    """States of some page views: by page, by A/B group, and by user and session."""
    bounced = F.col("scroll_depth").isNull() | (F.col("scroll_depth") < analytics.BOUNCE_BELOW)
    pages = _per(page_views.withColumnRenamed("page_url", "key"), ["key"], bounces=F.count_if(bounced))
    groups = _per(page_views.filter("ab_group IS NOT NULL").withColumnRenamed("ab_group", "key"), ["key"])
    times = {"first_time": F.min("event_time"), "last_time": F.max("event_time")}
    users = _per(page_views.withColumnRenamed("user_id", "key"), ["key", "session_id"], **times)
    return reduce(DataFrame.unionByName, (_state(pages, PAGES), _state(groups, VIEW_GROUPS), _state(users, USERS)))


def product_states(product_events: DataFrame) -> DataFrame:
    """States of some product events: by product, by A/B group, and the sessions of each group."""
    products = _per(product_events.withColumnRenamed("product_id", "key"), ["key"], revenue=F.sum("price"))
    grouped = product_events.filter("ab_group IS NOT NULL").withColumnRenamed("ab_group", "key")
    groups = _per(grouped, ["key"], sessions=F.hll_sketch_agg("session_id"))
    pairs = grouped.filter("session_id IS NOT NULL").select("key", "session_id").distinct()
    return reduce(
        DataFrame.unionByName,
        (_state(products, PRODUCTS), _state(groups, PRODUCT_GROUPS), _state(pairs, GROUP_SESSIONS)),
    )


STATES = {gold.PAGE_VIEWS: view_states, gold.PRODUCT_EVENTS: product_states}


def _of(states: DataFrame, kind: str) -> DataFrame:
    return states.filter(F.col("route") == kind)


def page_stats(states: DataFrame) -> DataFrame:
    """`analytics.page_stats` from the states of page views."""
    merged = _of(states, PAGES).groupBy(F.col("key").alias("page_url")).agg(
        F.sum("rows").alias("page_views"), F.sum("bounces").alias("bounces")
    )
    return merged.withColumn("bounce_rate", F.col("bounces") / F.col("page_views"))


def product_stats(states: DataFrame) -> DataFrame:
    """`analytics.product_stats` from the states of product events."""
    named = F.col("key").isNotNull() & (F.col("key") != "NaN")
    return _of(states, PRODUCTS).filter(named).groupBy(F.col("key").alias("product_id")).agg(
        F.sum("rows").alias("events_count"), F.sum("revenue").alias("total_revenue")
    )


def ab_test_summary(view_states: DataFrame, product_states: DataFrame, approximate: bool = False) -> DataFrame:
    """`analytics.ab_test_summary` from states; with `approximate`, sessions come from sketches alone (about 2 % off)."""
    views = _of(view_states, VIEW_GROUPS).groupBy(F.col("key").alias("ab_group")).agg(F.sum("rows").alias("page_views"))
    merged = _of(product_states, PRODUCT_GROUPS).groupBy(F.col("key").alias("ab_group"))
    events = F.sum("rows").alias("product_events")
    if approximate:
        products = merged.agg(events, F.hll_sketch_estimate(F.hll_union_agg("sessions")).alias("sessions_with_product"))
    else:
        pairs = _of(product_states, GROUP_SESSIONS).groupBy(F.col("key").alias("ab_group"))
        products = merged.agg(events).join(
            pairs.agg(F.count_distinct("session_id").alias("sessions_with_product")), "ab_group", "left"
        )
    return analytics.meet(views, products)


def user_sessions(states: DataFrame, user_id: str, skip: int = 0, limit: int = 20) -> DataFrame:
    """`analytics.user_sessions` from the states of page views."""
    sessions = _of(states, USERS).filter(F.col("key") == user_id).groupBy("session_id").agg(
        F.min("first_time").alias("first_event_time"),
        F.max("last_time").alias("last_event_time"),
        F.sum("rows").alias("page_views"),
    )
    return analytics.page_of(sessions, skip, limit)


def user_total_sessions(states: DataFrame, user_id: str) -> DataFrame:
    """`analytics.user_total_sessions` from the states of page views."""
    sessions = _of(states, USERS).filter(F.col("key") == user_id).select("session_id").distinct()
    return sessions.agg(F.count("*").alias("total_sessions"))


def merged(states: DataFrame) -> DataFrame:
    """States of the same kind and key as one, for keeping: reports on the result are the same."""
    counts = (F.sum(n).alias(n) for n in ("rows", "bounces"))
    return states.groupBy("route", "key", "session_id").agg(
        *counts, F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
        F.hll_union_agg("sessions").alias("sessions"), F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
    ).select(*STATE.fieldNames(), "route")
