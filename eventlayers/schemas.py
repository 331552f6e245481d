"""Declared row types of every layer. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_NTZ, _TS, _DATE = T.TimestampNTZType(), T.TimestampType(), T.DateType()
_PRICE = T.DecimalType(10, 2)

# A topic message, in the shape of Spark's Kafka source.
MESSAGE = _struct(
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
    ("topic", _S),
    ("partition", _I),
    ("offset", _L),
    ("timestamp", _TS),
)

EXTRA = _struct(
    ("ab_group", _S),
    ("scroll_depth", _I),
    ("payment_method", _S),
    ("basket_value", _D),
)

# Message keys; fixed values.
REQUIRED_KEYS = ("event_time", "session_id", "user_id", "event_type", "page_url")
OPTIONAL_KEYS = ("referrer_url", "user_agent", "ip_address", "product_id", "price", "extra")

# Raw layer. `extra_other` keeps payload keys that EXTRA does not name;
# (topic, partition, offset) is the provenance of the row and its dedupe key.
BRONZE = _struct(
    ("event_time", _S),
    ("session_id", _S),
    ("user_id", _S),
    ("event_type", _S),
    ("page_url", _S),
    ("referrer_url", _S),
    ("user_agent", _S),
    ("ip_address", _S),
    ("product_id", _S),
    ("price", _D),
    ("extra", EXTRA),
    ("extra_other", T.MapType(_S, _S)),
    ("topic", _S),
    ("partition", _I),
    ("offset", _L),
)

# Cleaned layer. The last four fields are declared and never populated.
SILVER = _struct(
    ("event_time", _NTZ),
    ("session_id", _S),
    ("user_id", _S),
    ("event_type", _S),
    ("page_url", _S),
    ("page_path", _S),
    ("page_host", _S),
    ("page_section", _S),
    ("page_category", _S),
    ("page_item", _S),
    ("referrer_url", _S),
    ("product_id", _S),
    ("price", _D),
    ("ab_group", _S),
    ("scroll_depth", _I),
    ("ip_address", _S),
    ("user_agent", _S),
    ("country", _S),
    ("city", _S),
    ("device_type", _S),
    ("browser_name", _S),
)

GOLD_PAGE_VIEW = _struct(
    ("event_time", _NTZ),
    ("session_id", _S),
    ("user_id", _S),
    ("page_url", _S),
    ("page_category", _S),
    ("page_item", _S),
    ("scroll_depth", _I),
    ("ab_group", _S),
)

GOLD_PRODUCT_EVENT = _struct(
    ("event_time", _NTZ),
    ("session_id", _S),
    ("user_id", _S),
    ("product_id", _S),
    ("price", _D),
    ("ab_group", _S),
    ("page_url", _S),
)

MART_PAGE_VIEW = T.StructType([*GOLD_PAGE_VIEW.fields, T.StructField("created_at", _TS)])
MART_PRODUCT_EVENT = T.StructType(
    [
        *(T.StructField(f.name, _PRICE if f.name == "price" else f.dataType) for f in GOLD_PRODUCT_EVENT),
        T.StructField("created_at", _TS),
    ]
)

# Append-only task log; the newest `seq` of a key is the task's current state.
TASK_KEY = ("event_type", "dataset", "layer", "partition_key")
TASK_LOG = _struct(
    ("event_type", _S),
    ("dataset", _S),
    ("layer", _S),
    ("partition_key", _S),
    ("status", _S),
    ("attempts", _I),
    ("next_retry_at", _TS),
    ("last_error", _S),
    ("created_at", _TS),
    ("updated_at", _TS),
    ("seq", _L),
)

WATERMARK_LOG = _struct(
    ("dataset", _S),
    ("layer", _S),
    ("last_processed_ts", _NTZ),
    ("last_processed_id", _L),
    ("updated_at", _TS),
    ("seq", _L),
)

RUN_COUNTERS = (
    "bronze_count",
    "silver_count",
    "gold_page_views_count",
    "gold_product_events_count",
    "loaded_page_views_count",
    "loaded_product_events_count",
)
RUN_LOG = _struct(
    ("run_id", _S),
    ("status", _S),
    *((c, _L) for c in RUN_COUNTERS),
    ("error_message", _S),
    ("at", _TS),
    ("seq", _L),
)


def names(schema: T.StructType) -> list[str]:
    return schema.fieldNames()


def plus(schema: T.StructType, **extra: T.DataType) -> T.StructType:
    """The schema with more (partition or provenance) columns at its end."""
    return T.StructType([*schema.fields, *(T.StructField(n, t, True) for n, t in extra.items())])
