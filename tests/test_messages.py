"""Decoding, quarantine, publishing and topic settings."""

import json

import pytest
from pyspark.sql import functions as F

from eventlayers import schemas
from eventlayers.sources import layers, messages

GOOD = {
    "event_time": "2026-05-17T12:00:00+00:00",
    "session_id": "s1",
    "user_id": "u1",
    "event_type": "purchase",
    "page_url": "https://shop.example.com/checkout/success",
    "referrer_url": None,
    "user_agent": "agent",
    "ip_address": "192.0.2.1",
    "product_id": "p1",
    "price": 12.5,
    "extra": {"ab_group": "A", "scroll_depth": 45, "payment_method": "card", "basket_value": 20.25},
}


def without(*keys):
    return {k: v for k, v in GOOD.items() if k not in keys}


def decoded(spark, *values):
    rows = [
        (b"k", v if v is None or isinstance(v, bytes) else (v if isinstance(v, str) else json.dumps(v)).encode(), i)
        for i, v in enumerate(values)
    ]
    frame = spark.createDataFrame(rows, "key binary, value binary, offset long").select(
        "key", "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset",
        F.lit("2026-05-17 00:00:00").cast("timestamp").alias("timestamp"),
    )
    return messages.decode(frame)


def reasons(spark, *values):
    return [r.reason for r in decoded(spark, *values).orderBy("offset").collect()]


def test_good_message(spark):
    row = messages.accepted(decoded(spark, GOOD)).first()
    assert row.asDict(recursive=True) == {
        **GOOD, "extra_other": None, "topic": "t", "partition": 0, "offset": 0,
    }


def test_reasons(spark):
    cases = {
        "{bad": "bad_json",
        "[1]": "bad_json",
        "123": "bad_json",
        "null": "bad_json",
        "": "bad_json",
        None: "bad_json",
        b"\xff\xfe{}": "bad_json",
        json.dumps(GOOD) + " trailing": "bad_json",
        json.dumps(GOOD | {"colour": "red"}): "unknown_keys",
        json.dumps(without("event_type")): "missing_keys",
        json.dumps(GOOD | {"price": "cheap"}): "wrong_type",
        json.dumps(GOOD | {"price": True}): "wrong_type",
        json.dumps(GOOD | {"extra": [1]}): "wrong_type",
        json.dumps(GOOD | {"extra": {"scroll_depth": "deep"}}): "wrong_type",
        json.dumps(GOOD | {"price": float("nan")}): None,
        json.dumps(GOOD | {"session_id": None}): None,
        json.dumps(without("price", "extra", "referrer_url")): None,
        " " + json.dumps(GOOD) + " ": None,
    }
    assert reasons(spark, *cases) == list(cases.values())


def test_one_bad_message_does_not_take_the_batch_along(spark):
    frame = decoded(spark, GOOD, "{bad", GOOD)
    assert messages.accepted(frame).count() == 2
    bad = messages.quarantined(frame).first()
    assert (bad.offset, bad.raw_value, bad.reason) == (1, "{bad", "bad_json")


def test_payload_absent_null_and_open(spark):
    rows = decoded(
        spark, without("extra"), GOOD | {"extra": None}, GOOD | {"extra": {}},
        GOOD | {"extra": {"ab_group": "B", "theme": "dark", "nested": {"a": 1}}},
    ).orderBy("offset").collect()
    empty = dict.fromkeys(schemas.names(schemas.EXTRA))
    assert [r.extra and r.extra.asDict() for r in rows] == [empty, None, empty, empty | {"ab_group": "B"}]
    assert [r.extra_other for r in rows] == [None, None, None, {"theme": "dark", "nested": '{"a":1}'}]


def test_nan_price_is_null(spark):
    assert decoded(spark, GOOD | {"price": float("nan")}).first().price is None


def test_roundtrip_and_default_key(spark):
    row = messages.accepted(decoded(spark, GOOD))
    sent = messages.encode(row.unionByName(row.withColumn("session_id", F.lit(None).cast("string"))))
    keys = [bytes(r.key).decode() for r in sent.collect()]
    assert keys == ["s1", "unknown"]
    assert json.loads(bytes(sent.first().value).decode()) == GOOD


def test_topic_settings():
    options = messages.topic_options("broker:9092", max_offsets_per_trigger=100)
    assert options["subscribe"] == "sessions_raw"
    assert options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "100"


def test_dedupe_by_offset(spark):
    row = messages.accepted(decoded(spark, GOOD, GOOD))
    assert messages.dedupe_by_offset(row.unionByName(row)).count() == 2


def test_next_offsets(spark):
    frame = decoded(spark, GOOD, GOOD)
    assert [tuple(r) for r in messages.next_offsets(frame).collect()] == [("t", 0, 2)]


# --- layer files ---------------------------------------------------------------------------


def test_scan_files_names_and_failure(spark, tmp_path):
    spark.range(4).repartition(2).write.parquet(str(tmp_path / "2026/05/17"))
    schema = schemas.T.StructType([schemas.T.StructField("id", schemas.T.LongType())])
    rows = layers.scan_files(spark, str(tmp_path), schema).collect()
    assert sorted(r.id for r in rows) == [0, 1, 2, 3]
    assert all(r.object_name == f"2026/05/17/{r.filename}" for r in rows)
    listed = layers.list_files(spark, str(tmp_path)).collect()
    assert {r.object_name for r in listed} == {r.object_name for r in rows}
    (tmp_path / "2026/05/17/broken.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="broken"):
        layers.scan_files(spark, str(tmp_path), schema).collect()


def test_listing_of_a_missing_folder_is_empty(spark, tmp_path):
    assert layers.list_files(spark, str(tmp_path / "none")).count() == 0


def test_legacy_files_with_null_typed_columns(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"product_id": pa.nulls(2), "price": pa.nulls(2)}), tmp_path / "a.parquet")
    pq.write_table(pa.table({"product_id": ["p"], "price": [1.5]}), tmp_path / "b.parquet")
    schema = schemas.T.StructType([f for f in schemas.BRONZE if f.name in ("product_id", "price")])
    rows = layers.scan_files(spark, str(tmp_path), schema, legacy=True)
    assert sorted((r.product_id or "", r.price or 0) for r in rows.collect()) == [("", 0), ("", 0), ("p", 1.5)]
    assert spark.conf.get("spark.sql.parquet.enableVectorizedReader") == "true"


def test_flatten_batches(spark):
    df = spark.sql("SELECT array(array(struct(1 AS a), struct(2 AS a)), array(), array(struct(3 AS a))) AS b")
    assert sorted(r.a for r in layers.flatten_batches(df, "b").collect()) == [1, 2, 3]


def test_write_layer_appends_by_partition(spark, tmp_path):
    rows = spark.sql("SELECT 1L AS id, DATE'2026-05-17' AS event_date")
    for _ in range(2):
        layers.write_layer(rows, str(tmp_path / "layer"), ["event_date"])
    assert spark.read.parquet(str(tmp_path / "layer")).filter("event_date = DATE'2026-05-17'").count() == 2
