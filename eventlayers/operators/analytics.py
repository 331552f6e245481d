"""The four read queries on the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
BOUNCE_BELOW = 30
_MAX_LIMIT = 100


def _check_limit(limit: int) -> None:
    if not 1 <= limit <= _MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {_MAX_LIMIT}: {limit}")


def page_stats(page_views: DataFrame) -> DataFrame:
    """Views, bounces (nothing or little scrolled) and bounce rate of every page."""
    bounced = F.col("scroll_depth").isNull() | (F.col("scroll_depth") < BOUNCE_BELOW)
    return (
        page_views.groupBy("page_url")
        .agg(F.count("*").alias("page_views"), F.count_if(bounced).alias("bounces"))
        .withColumn("bounce_rate", F.col("bounces") / F.col("page_views"))
    )


def top_landing_pages(page_views: DataFrame, limit: int = 10) -> DataFrame:
    return first_pages(page_stats(page_views), limit)


def first_pages(stats: DataFrame, limit: int = 10) -> DataFrame:
    _check_limit(limit)
    return stats.orderBy(F.desc("page_views"), "page_url").limit(limit)


def product_stats(product_events: DataFrame) -> DataFrame:
    """Events and revenue of every product; revenue is null where no event has a price.

    Revenue adds up carts and purchases alike: the mart does not tell them apart.
    """
    named = F.col("product_id").isNotNull() & (F.col("product_id") != "NaN")
    return (
        product_events.filter(named)
        .groupBy("product_id")
        .agg(F.count("*").alias("events_count"), F.sum("price").alias("total_revenue"))
    )


def top_products(product_events: DataFrame, limit: int = 10) -> DataFrame:
    """Products by revenue; those without any price come last and show 0."""
    return first_products(product_stats(product_events), limit)


def first_products(stats: DataFrame, limit: int = 10) -> DataFrame:
    _check_limit(limit)
    top = stats.orderBy(F.desc_nulls_last("total_revenue"), "product_id").limit(limit)
    return top.withColumn("total_revenue", F.coalesce(F.col("total_revenue").cast("double"), F.lit(0.0)))


def ab_test_summary(page_views: DataFrame, product_events: DataFrame) -> DataFrame:
    """Per group with page views: views, sessions with a product, product events.

    Both sides are aggregated to one row per group before they meet.
    """
    views = (
        page_views.filter("ab_group IS NOT NULL").groupBy("ab_group").agg(F.count("*").alias("page_views"))
    )
    products = (
        product_events.filter("ab_group IS NOT NULL")
        .groupBy("ab_group")
        .agg(
            F.count_distinct("session_id").alias("sessions_with_product"),
            F.count("*").alias("product_events"),
        )
    )
    return meet(views, products)


def meet(views: DataFrame, products: DataFrame) -> DataFrame:
    """The two sides of the A/B summary, a row per group each."""

    def or_zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).alias(name)

    return (
        views.join(products, "ab_group", "left")
        .select("ab_group", "page_views", or_zero("sessions_with_product"), or_zero("product_events"))
        .orderBy("ab_group")
    )


def user_sessions(page_views: DataFrame, user_id: str, skip: int = 0, limit: int = 20) -> DataFrame:
    """A page of one user's sessions, newest first."""
    sessions = (
        page_views.filter(F.col("user_id") == user_id)
        .groupBy("session_id")
        .agg(
            F.min("event_time").alias("first_event_time"),
            F.max("event_time").alias("last_event_time"),
            F.count("*").alias("page_views"),
        )
    )
    return page_of(sessions, skip, limit)


def page_of(sessions: DataFrame, skip: int, limit: int) -> DataFrame:
    """A page of sessions, newest first."""
    _check_limit(limit)
    if skip < 0:
        raise ValueError(f"skip must not be negative: {skip}")
    return sessions.orderBy(F.desc("first_event_time"), "session_id").offset(skip).limit(limit)


def user_total_sessions(page_views: DataFrame, user_id: str) -> DataFrame:
    """All sessions of a user; a missing session id counts as one session."""
    sessions = page_views.filter(F.col("user_id") == user_id).select("session_id").distinct()
    return sessions.agg(F.count("*").alias("total_sessions"))
