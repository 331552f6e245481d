"""Token counts from a cache of digests.

The cache is a table of (tokenizer version, content digest, tokens) in the shared folder. A run joins the digests of its
texts to it, encodes only the distinct texts it does not have, appends their counts, and reads every count from the
cache. Each run appends a folder of its own, so runs may overlap; what one has written, the next ones find.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlayers.llm.bpe import CHUNK_BYTES, default_vocabulary, encoder
from eventlayers.llm.common import chunks, id_and_text, text_bytes
from eventlayers.session import shared_dir

CACHE = "version string, digest string, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    """The digest of the vocabulary file: counts of another vocabulary are never taken."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _exists(spark, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_cache(spark, path: str, version: str) -> DataFrame:
    """Digest and count of one tokenizer version; no rows where there is no cache yet."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "digest string, n_tokens bigint")
    rows = spark.read.schema(CACHE).option("recursiveFileLookup", "true").parquet(path).where(F.col("version") == version)
    # Runs that overlap may both add a text.
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, cache_path: str | None = None, vocabulary: str | None = None, limit: int = 512
) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit` of every document; new counts are appended to the cache.

    Content is normalised only where that cannot change a count: null becomes empty. Copies, also under one id,
    are encoded once and each row gets the count. An empty table gives no rows and adds none. Without
    `cache_path` the cache is the one of this tokenizer version in the folder that `spark.checkpoint.dir` names; a
    local session without that setting begins a new one.
    """
    spark = docs.sparkSession
    path = vocabulary or default_vocabulary()
    version = tokenizer_version(path)
    cache_path = cache_path or f"{shared_dir(spark)}/eventlayers/token-counts/{version}"
    keyed = id_and_text(docs).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    # Dealt by the digest alone, as the cache is: texts move once, one of each digest from a task.
    texts = keyed.select("digest", "text").dropDuplicates(["digest"])
    if _exists(spark, cache_path):
        texts = texts.join(read_cache(spark, cache_path, version), "digest", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        for batch in batches:
            data = text_bytes(batch.column(1))
            for part in chunks([len(t) for t in data], 4 * CHUNK_BYTES):
                counts = [len(x) // 4 for x in codec.encode(data[part])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([version] * len(counts)), batch.column(0)[part], pa.array(counts, pa.int64())],
                    names=["version", "digest", "n_tokens"],
                )

    texts.mapInArrow(run, CACHE).write.parquet(f"{cache_path}/run={uuid.uuid4().hex}")
    narrow = keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    return narrow.join(read_cache(spark, cache_path, version), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
