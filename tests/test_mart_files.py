"""Mart files: one open at a time in a task, sorted by the lookup key."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from eventlayers.operators import marts
from eventlayers.sources import layers


def test_a_task_of_sorted_rows_opens_one_file_at_a_time(spark, tmp_path):
    rows = spark.range(5000).select(
        F.concat(F.lit("u"), (F.col("id") * 7919 % 311).cast("string")).alias("user_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("event_date"),
        F.when(F.col("id") % 9 > 0, "rows").otherwise("quarantine").alias("route"),
    )
    dealt = marts.clustered(rows, "route", "event_date", sort_key="user_id")
    layers.publish_batch(dealt, str(tmp_path), "w", 0, ["route", "event_date"], key="user_id", **layers.lookup_options("user_id"))
    # Each open file holds megabytes of key filters; 32 of them in a task ran out of memory.
    assert dealt.sparkSession.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    files = [pq.ParquetFile(f).read(columns=["user_id"])["user_id"].to_pylist() for f in glob.glob(f"{tmp_path}/writer=*/**/*.parquet", recursive=True)]
    assert sum(map(len, files)) == 5000
    assert all(f == sorted(f) for f in files)
