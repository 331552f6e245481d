"""Cleaned rows to the two overlapping gold outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlayers.functions import is_missing
from eventlayers.schemas import GOLD_PAGE_VIEW, GOLD_PRODUCT_EVENT, names

PAGE_VIEWS = "gold_page_views"
PRODUCT_EVENTS = "gold_product_events"

# Fixed value: marks a product page anywhere in the URL, query included.
_PRODUCT_PAGE = "/product/"


def is_page_view(page_url: Column) -> Column:
    """Any event whose URL is not a product page, whatever its type."""
    return page_url.isNull() | ~page_url.contains(_PRODUCT_PAGE)


def is_product_event(product_id: Column) -> Column:
    return ~is_missing(product_id)


def page_views(silver: DataFrame) -> DataFrame:
    return silver.filter(is_page_view(F.col("page_url"))).select(*names(GOLD_PAGE_VIEW))


def product_events(silver: DataFrame) -> DataFrame:
    return silver.filter(is_product_event(F.col("product_id"))).select(*names(GOLD_PRODUCT_EVENT))


def routed(silver: DataFrame, *keep: str) -> DataFrame:
    """Both outputs from one pass: a row per output the event belongs to, named by `route`.

    The outputs overlap (a purchase on a plain page is in both) and leave events out
    (a product page without a product id is in neither). Columns foreign to a route are null.
    """
    outputs = F.array_compact(
        F.array(
            F.when(is_page_view(F.col("page_url")), PAGE_VIEWS),
            F.when(is_product_event(F.col("product_id")), PRODUCT_EVENTS),
        )
    )
    views, products = names(GOLD_PAGE_VIEW), names(GOLD_PRODUCT_EVENT)
    columns = views + [n for n in products if n not in views]

    def of_route(name: str) -> Column:
        if name in views and name in products:
            return F.col(name)
        owner = PAGE_VIEWS if name in views else PRODUCT_EVENTS
        return F.when(F.col("route") == owner, F.col(name)).alias(name)

    return silver.select(*columns, *keep, F.explode(outputs).alias("route")).select(
        *map(of_route, columns), *keep, "route"
    )
