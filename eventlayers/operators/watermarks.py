"""High watermarks per (dataset, layer): reporting only, never a filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def current_watermarks(log: DataFrame) -> DataFrame:
    """Time never moves back; the id is the last one given; a key without times has none."""
    given = F.when(F.col("last_processed_id").isNotNull(), F.col("seq"))
    return log.groupBy("dataset", "layer").agg(
        F.max("last_processed_ts").alias("last_processed_ts"),
        F.max_by("last_processed_id", given).alias("last_processed_id"),
        F.max("updated_at").alias("updated_at"),
    )


def layer_watermark(rows: DataFrame, dataset: str, layer: str) -> DataFrame:
    return rows.agg(F.max("event_time").alias("last_processed_ts")).select(
        F.lit(dataset).alias("dataset"), F.lit(layer).alias("layer"), "last_processed_ts"
    )
