"""The shared `events` table (event_id, ts, user_id, event_type, value, props) as web events.

The table has no sessions, URLs, products or faults; they are derived row by row from its
columns, by rules that SQL can repeat, so each layer has rows to work on and to compare.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlayers.functions import canonical_uuid, with_url_parts
from eventlayers.schemas import BRONZE, MESSAGE, SILVER, names
from eventlayers.sources.messages import TOPIC, encode

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

SHOP = "https://shop.example.com"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream; a pattern, for a stream's plain path must be a folder."""
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/event[s].parquet")


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def day(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def web_events(events: DataFrame) -> DataFrame:
    """Clean web events: event_id and the columns of the cleaned layer that do not need a URL split."""
    kind = (
        F.when(F.col("event_type") == "purchase", "purchase")
        .when(F.col("event_type") == "click", "add_to_cart")
        .otherwise("page_view")
    )
    item = _text(F.col("event_id") % 50)
    product_page = F.concat(F.lit("/product/"), item)
    browsed = (
        F.when(F.col("event_id") % 7 == 0, "/category/components/brakes")
        .when(F.col("event_id") % 7 == 1, "/search?q=bike+light")
        .when(F.col("event_id") % 7 == 2, product_page)
        .when(F.col("event_id") % 7 == 3, "/category/road-bikes?frame=carbon")
        .when(F.col("event_id") % 7 == 4, "/promo/spring-sale")
        .otherwise("/home")
    )
    path = (
        F.when(F.col("event_type") == "purchase", "/checkout/success")
        .when(F.col("event_type") == "click", product_page)
        .otherwise(browsed)
    )
    commerce = F.col("event_type").isin("purchase", "click")
    product = F.when(_every(23), " NaN ").when(_every(29), "").otherwise(F.concat(F.lit("p"), item))
    group = F.when(F.col("user_id") % 3 == 0, "A").when(F.col("user_id") % 3 == 1, "B")
    return events.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.concat(F.lit("s"), _text("user_id"), F.lit("-"), day(F.col("ts"))).alias("session_id"),
        F.concat(F.lit("u"), _text("user_id")).alias("user_id"),
        kind.alias("event_type"),
        F.concat(F.lit(SHOP), path).alias("page_url"),
        F.when(commerce, product).alias("product_id"),
        F.when(commerce, F.col("value")).alias("price"),
        group.alias("ab_group"),
        F.when(~_every(11), F.get_json_object("props", "$.k").cast("int")).alias("scroll_depth"),
    )


def raw_events(events: DataFrame, faults: bool = True) -> DataFrame:
    """Web events as raw rows: time as ISO text in five forms, payload nested.

    With `faults`, some rows carry an unreadable time, a broken host or a null payload.
    """
    wall = F.col("event_time").cast("string")
    iso = F.replace(wall, F.lit(" "), F.lit("T"))
    ahead = F.replace(
        F.timestamp_add("HOUR", F.lit(2), F.col("event_time")).cast("string"), F.lit(" "), F.lit("T")
    )
    basic = F.translate(F.substring(iso, 1, 19), "-:", "")
    form = F.col("event_id") % 5
    time = (
        F.when(form == 0, F.concat(iso, F.lit("+00:00")))
        .when(form == 1, F.concat(iso, F.lit("Z")))
        .when(form == 2, iso)
        .when(form == 3, F.concat(ahead, F.lit("+02:00")))
        .otherwise(basic)
    )
    url = F.col("page_url")
    extra = F.struct(
        "ab_group",
        "scroll_depth",
        F.lit(None).cast("string").alias("payment_method"),
        F.lit(None).cast("double").alias("basket_value"),
    )
    if faults:
        time = F.when(_every(31), "yesterday").otherwise(time)
        host = F.when(_every(37), "https://[shop").when(_every(43), "https://[shop]")
        url = F.when(host.isNotNull(), F.replace(url, F.lit(SHOP), host)).otherwise(url)
        extra = F.when(~_every(41), extra)
    values = {
        "event_time": time,
        "page_url": url,
        "extra": extra,
        "topic": F.lit(TOPIC),
        "partition": F.col("event_id") % 3,
        "offset": F.col("event_id"),
    }
    given = web_events(events)
    return given.select(
        *(
            values.get(f.name, F.col(f.name) if f.name in given.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in BRONZE
        ),
        "event_id",
        F.col("event_time").alias("sent_at"),
    )


def topic_messages(events: DataFrame, faults: bool = True) -> DataFrame:
    """Raw rows as topic messages, in which `faults` breaks some of the JSON texts."""
    rows = raw_events(events, faults)
    sent_at = F.col("sent_at").cast("timestamp").alias("timestamp")
    sent = encode(rows, "event_id", "topic", "partition", "offset", sent_at)
    value = F.col("value").cast("string")
    if faults:
        body = F.substr(value, F.lit(1), F.length(value) - 1)
        value = (
            F.when(_every(101), F.lit("{bad"))
            .when(_every(103), F.concat(body, F.lit(',"colour":"red"}')))
            .when(_every(107), F.regexp_replace(value, r'"event_type":"[^"]*",', ""))
            .when(_every(109), F.regexp_replace(value, r'"price":[^,]*,', '"price":"cheap",'))
            .when(_every(113), F.concat(value, value))
            .when(_every(127), F.concat(value, F.lit(" x}")))
            .otherwise(value)
        )
    return sent.withColumn("value", value.cast("binary")).select(*names(MESSAGE))


def silver_events(events: DataFrame) -> DataFrame:
    """The cleaned layer of the table, without the detour over raw text."""
    rows = with_url_parts(web_events(events))
    return rows.select(
        *(
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SILVER
        )
    )


def hourly_file(ts: Column) -> Column:
    folder, hour = F.date_format(ts, "yyyy/MM/dd"), F.date_format(ts, "yyyyMMdd_HH")
    return F.concat(folder, F.lit("/events_"), hour, F.lit(".parquet"))


def files(events: DataFrame) -> DataFrame:
    """One file per event hour, with its number, size and last event."""
    return events.groupBy(hourly_file(F.col("ts")).alias("object_name")).agg(
        F.count("*").alias("rows"),
        F.sum(F.length("props")).alias("bytes"),
        F.max("ts").alias("modified_at"),
        F.max("event_id").alias("last_id"),
    )


def session_records(events: DataFrame) -> DataFrame:
    """Star records: session ids in four spellings of a UUID, some unreadable or missing."""
    digest, canonical = F.col("_digest"), F.col("_canonical")
    events = events.withColumn(
        "_digest", F.md5(F.concat_ws("/", _text("user_id"), day(F.col("ts"))).cast("binary"))
    ).withColumn("_canonical", canonical_uuid(digest))
    form = F.col("event_id") % 17
    session = (
        F.when(form == 0, F.concat(F.lit("session-"), _text(F.col("event_id") % 5)))
        .when(form == 1, F.lit(None))
        .when(form % 4 == 0, canonical)
        .when(form % 4 == 1, digest)
        .when(form % 4 == 2, F.concat(F.lit("{"), F.upper(canonical), F.lit("}")))
        .otherwise(F.concat(F.lit("urn:uuid:"), canonical))
    )
    browsers = F.when(F.col("event_id") % 4 == 0, "firefox").when(F.col("event_id") % 4 == 1, "chrome")
    return events.select(
        "event_id",
        "user_id",
        session.alias("session_id"),
        F.col("ts").alias("timestamp"),
        F.when(~_every(13), F.col("event_type")).otherwise(F.lit("")).alias("event_type"),
        browsers.alias("browser"),
        F.when(F.col("event_id") % 3 == 0, "mobile").otherwise(F.lit("desktop")).alias("device"),
    )

