"""Gold rows to mart rows, with the mart's own constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlayers.functions import key_part, nan_to_null
from eventlayers.schemas import MART_PAGE_VIEW, MART_PRODUCT_EVENT, names

# The mart's declared lengths, required columns and insert chunk.
_LENGTHS = {"session_id": 200, "user_id": 200, "product_id": 200, "ab_group": 50}
_REQUIRED = {
    "gold_page_views": ("event_time", "session_id", "page_url"),
    "gold_product_events": ("event_time", "session_id", "product_id", "page_url"),
}
INSERT_CHUNK = 10_000

_ROWS = {"gold_page_views": MART_PAGE_VIEW, "gold_product_events": MART_PRODUCT_EVENT}


def _column(name: str, kind: T.DataType, loaded_at: Column) -> Column:
    if name == "created_at":
        return loaded_at.cast(kind).alias(name)
    if isinstance(kind, T.DecimalType):
        return F.col(name).try_cast(kind).alias(name)
    return F.col(name)


def classify(gold: DataFrame, table: str, loaded_at: Column | None = None, *keep: str) -> DataFrame:
    """Gold rows as mart rows plus `reason`: what the mart would refuse them for, else null.

    Too long a text is refused, never cut.
    """
    clean = nan_to_null(gold)
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    reason = F.lit(None).cast("string")
    if table == "gold_product_events":
        too_big = F.col("price").isNotNull() & F.col("price").try_cast("decimal(10,2)").isNull()
        reason = F.when(too_big, "price_overflow")
    for name, length in _LENGTHS.items():
        if name in clean.columns:
            reason = F.when(F.char_length(name) > length, f"too_long:{name}").otherwise(reason)
    for name in _REQUIRED[table]:
        reason = F.when(F.col(name).isNull(), f"null:{name}").otherwise(reason)
    return clean.select(
        *(_column(f.name, f.dataType, stamp) for f in _ROWS[table]), *keep, reason.alias("reason")
    )


def mart_rows(gold: DataFrame, table: str, loaded_at: Column | None = None) -> DataFrame:
    rows = classify(gold, table, loaded_at).filter("reason IS NULL")
    return rows.select(*names(_ROWS[table]))


def mart_rejects(gold: DataFrame, table: str) -> DataFrame:
    return classify(gold, table).filter("reason IS NOT NULL").drop("created_at")


def clustered(rows: DataFrame, *partition_by: str, sort_key: str) -> DataFrame:
    """Rows gathered per output folder and part of the lookup keys, and sorted inside each file by the key.

    REBALANCE lets adaptive execution split a folder that holds most of the batch and join
    small ones, so one busy day is many tasks; a key's rows of a day share a file, and the key
    filters of the other files keep a lookup out of them.
    """
    dealt = rows.withColumn("_part", key_part(sort_key))
    return dealt.hint("rebalance", *partition_by, "_part").sortWithinPartitions(*partition_by, sort_key).drop("_part")


def write_jdbc(rows: DataFrame, url: str, table: str, **properties: str) -> None:
    """Append to a relational mart. At-least-once: JDBC has no batch to overwrite."""
    rows.write.mode("append").option("batchsize", INSERT_CHUNK).jdbc(url, table, properties=properties)
