"""Row and file counts of the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_counts(rows: DataFrame, layer: str, file: str = "object_name") -> DataFrame:
    """Rows per file of one layer; no data column is read."""
    return rows.groupBy(F.lit(layer).alias("layer"), F.col(file).alias("object_name")).agg(
        F.count("*").alias("rows")
    )


def layer_stats(*counts: DataFrame, layers: tuple[str, ...] = ()) -> DataFrame:
    """Rows and files of every layer in `counts`, and of both gold layers together as `gold`.

    Those of `layers` that have no files get a row of zeros.
    """
    files = reduce(DataFrame.unionByName, counts)
    layer = F.col("layer")
    groups = F.when(layer.startswith("gold_"), F.array(layer, F.lit("gold"))).otherwise(F.array(layer))
    found = files.select(F.explode(groups).alias("layer"), "rows")
    known = files.sparkSession.createDataFrame([(n,) for n in layers], "layer string").withColumn(
        "rows", F.lit(None).cast("long")
    )
    return (
        found.unionByName(known)
        .groupBy("layer")
        .agg(F.count("rows").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    )
