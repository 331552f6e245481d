"""Raw rows to cleaned rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlayers.functions import has_valid_host, iso_parts, iso_timestamp, keep_where, with_url_parts
from eventlayers.schemas import SILVER, names

_COPIED = (
    "session_id", "user_id", "event_type", "page_url", "referrer_url",
    "product_id", "price", "ip_address", "user_agent",
)
_FROM_URL = ("page_path", "page_host", "page_section", "page_category", "page_item")


def classify(bronze: DataFrame) -> DataFrame:
    """Every raw row as a cleaned row, with `reason` saying why it cannot be one (else null).

    Columns beyond the raw schema (provenance) pass through.
    """
    raw_time = F.col("event_time")
    parsed = with_url_parts(bronze.withColumn("_iso", iso_parts(raw_time))).withColumn(
        "_event_time", iso_timestamp(raw_time, F.col("_iso"))
    )
    values = {n: F.col(n) for n in (*_COPIED, *_FROM_URL)}
    values |= {
        "event_time": F.col("_event_time"),
        "ab_group": F.col("extra.ab_group"),
        "scroll_depth": F.col("extra.scroll_depth"),
    }
    reason = (
        F.when(~has_valid_host(F.col("page_url"), F.col("page_host")), "bad_url")
        .when(F.col("extra").isNull(), "null_extra")
        .when(F.col("_event_time").isNull(), "bad_event_time")
    )
    kept = [c for c in bronze.columns if c not in names(SILVER) and c not in ("extra", "extra_other")]
    return parsed.select(
        *(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SILVER),
        raw_time.alias("raw_event_time"),
        *kept,
        reason.alias("reason"),
    )


def bronze_to_silver(bronze: DataFrame, mode: str = "quarantine") -> DataFrame:
    """The cleaned rows. `failfast` raises on the first row `quarantine` would leave out."""
    if mode not in ("quarantine", "failfast"):
        raise ValueError(f"unknown mode: {mode}")
    rows = classify(bronze)
    if mode == "failfast":
        checked = F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason")).cast("timestamp_ntz"))
        rows = rows.withColumn("event_time", checked.otherwise(F.col("event_time")))
    else:
        rows = keep_where(rows, F.col("reason").isNull())
    return rows.select(*names(SILVER))


def silver_rejects(bronze: DataFrame) -> DataFrame:
    """The rows that stay behind, with their reason and raw time text."""
    rows = keep_where(classify(bronze), F.col("reason").isNotNull())
    return rows.drop("event_time", *_FROM_URL)
