"""The corpus pipeline: five stages, each written as Parquet and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlayers.llm import packing, pii, quality, sigtree, toxicity
from eventlayers.llm.common import materialise, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network predicts toxic go; it learns from the labels of the documents at hand."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    return sigtree.one_of_each(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values are replaced, and terms that disclose them generalised or removed."""
    return pii.sanitise(docs, **pii.WHOLE)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_quality),
    ("near_copies", drop_near_copies),
    ("pii", sanitise),
    ("packing", pack),
]

#: Learned scores, components and encoding are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{name}")
    return docs
