"""Topic messages: reading, decoding with strict keys, quarantine, publishing.

The operators work on frames of the MESSAGE schema, batch or streaming; only
`read_topic` and `publish` need the Kafka connector on the class path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlayers.functions import keep_where, nan_to_null
from eventlayers.schemas import BRONZE, EXTRA, MESSAGE, OPTIONAL_KEYS, REQUIRED_KEYS, names

# Fixed values of the topic and its clients.
TOPIC = "sessions_raw"
NO_SESSION_KEY = "unknown"
_PRODUCER = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.linger.ms": "5",
    "kafka.batch.size": "32768",
    "kafka.retries": "3",
}
# Fixed value: how often a followed topic is written out.
FLUSH_SECONDS = 5

_UNPARSED = "_unparsed"
_DECODED = T.StructType(
    [
        *(
            T.StructField(f.name, T.MapType(T.StringType(), T.StringType()) if f.name == "extra" else f.dataType)
            for f in BRONZE
            if f.name in REQUIRED_KEYS + OPTIONAL_KEYS
        ),
        T.StructField(_UNPARSED, T.StringType()),
    ]
)
_STRICT = {"columnNameOfCorruptRecord": _UNPARSED, "allowSingleQuotes": "false"}


def topic_options(
    servers: str,
    topic: str = TOPIC,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Kafka source options. `min_partitions` cuts topic partitions into more tasks than there are."""
    limits = {"maxOffsetsPerTrigger": max_offsets_per_trigger, "minPartitions": min_partitions}
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    } | {name: str(value) for name, value in limits.items() if value}


def read_topic(spark: SparkSession, servers: str, topic: str = TOPIC, **limits: int) -> DataFrame:
    """The topic as a stream from its beginning; offsets live in the query's checkpoint."""
    return (
        spark.readStream.format("kafka")
        .options(**topic_options(servers, topic, **limits))
        .load()
        .select(*names(MESSAGE))
    )


def publish(events: DataFrame, servers: str, topic: str = TOPIC) -> None:
    (
        encode(events)
        .write.format("kafka")
        .options(**_PRODUCER)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def encode(events: DataFrame, *keep: str | Column) -> DataFrame:
    """Key and JSON value of each event (nulls are written out), and the columns to keep."""
    fields = [n for n in names(BRONZE) if n in REQUIRED_KEYS + OPTIONAL_KEYS and n in events.columns]
    return events.select(
        F.coalesce("session_id", F.lit(NO_SESSION_KEY)).cast("binary").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        *keep,
    )


def _payload(extra: Column, name: str, kind: T.DataType) -> Column:
    return F.try_element_at(extra, F.lit(name)).try_cast(kind)


def _is_wrong(extra: Column, name: str, kind: T.DataType) -> Column:
    there = F.try_element_at(extra, F.lit(name)).isNotNull()
    return F.coalesce(there & _payload(extra, name, kind).isNull(), F.lit(False))


def decode(messages: DataFrame, *keep: str | Column) -> DataFrame:
    """Messages to raw rows plus `reason` (null when good), `raw_value`, the message time, and what to keep.

    A text is good if it is one JSON object and nothing else: between brackets it must be an array of
    one, which it is not if an object or a stray mark follows.

    A bad message never takes its neighbours along: it stays in the frame with a reason,
    and with the text it came with.
    """
    text, keys, extra = F.col("raw_value"), F.col("_keys"), F.col("_row.extra")
    parsed = messages.select(
        F.col("value").cast("string").alias("raw_value"), "topic", "partition", "offset", "timestamp", *keep
    ).select("*", F.from_json(text, _DECODED, _STRICT).alias("_row"), F.from_json(
        F.concat(F.lit("["), text, F.lit("]")), "array<map<string,string>>", {"allowSingleQuotes": "false"}
    ).alias("_objects"))
    kept = [c for c in parsed.columns if c not in ("topic", "partition", "offset", "timestamp", "raw_value", "_row", "_objects")]
    one = F.when(F.size("_objects") == 1, F.get("_objects", F.lit(0)))
    parsed = parsed.select(*(c for c in parsed.columns if c != "_objects"), F.map_keys(one).alias("_keys"))

    known = F.array(*map(F.lit, REQUIRED_KEYS + OPTIONAL_KEYS))
    required = F.array(*map(F.lit, REQUIRED_KEYS))
    whole = F.rtrim(text).endswith("}") & F.is_valid_utf8(text)
    wrong_type = reduce(
        Column.__or__,
        (_is_wrong(extra, f.name, f.dataType) for f in EXTRA if f.dataType != T.StringType()),
        F.col(f"_row.{_UNPARSED}").isNotNull(),
    )
    reason = (
        F.when(keys.isNull() | ~F.coalesce(whole, F.lit(False)), "bad_json")
        .when(F.size(F.array_except(keys, known)) > 0, "unknown_keys")
        .when(F.size(F.array_except(required, keys)) > 0, "missing_keys")
        .when(wrong_type, "wrong_type")
    )
    # An absent payload is an empty one; a payload written as null stays null.
    no_payload = ~F.array_contains(keys, "extra")
    lifted = F.when(
        extra.isNotNull() | no_payload,
        F.struct(*(_payload(extra, f.name, f.dataType).alias(f.name) for f in EXTRA)),
    )
    has_other = F.size(F.array_except(F.map_keys(extra), F.array(*map(F.lit, names(EXTRA))))) > 0
    other = F.map_filter(extra, lambda name, _: ~name.isin(*names(EXTRA)))
    plain = [n for n in names(_DECODED) if n not in ("extra", _UNPARSED)]
    return nan_to_null(
        parsed.select(
            *(F.col(f"_row.{n}").alias(n) for n in plain),
            lifted.alias("extra"),
            F.when(has_other, other).alias("extra_other"),
            "topic",
            "partition",
            "offset",
            "timestamp",
            "raw_value",
            reason.alias("reason"),
            *kept,
        )
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return keep_where(decoded, F.col("reason").isNull()).select(*names(BRONZE))


def quarantined(decoded: DataFrame) -> DataFrame:
    bad = keep_where(decoded, F.col("reason").isNotNull())
    return bad.select("topic", "partition", "offset", "raw_value", "reason")


def next_offsets(messages: DataFrame) -> DataFrame:
    """The offset each topic partition continues at; for lag reports, the checkpoint keeps its own."""
    return messages.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def dedupe_by_offset(rows: DataFrame, within: str | None = None, time: str = "timestamp") -> DataFrame:
    """One row per (topic, partition, offset), for topics replayed by hand.

    On a stream `within` bounds the state: a repeat that comes later than this after the newest `time` passes.
    """
    key = ["topic", "partition", "offset"]
    if within is None:
        return rows.dropDuplicates(key)
    return rows.withWatermark(time, within).dropDuplicatesWithinWatermark(key)
