"""Session records to a users / sessions / events star."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlayers.functions import canonical_uuid, epoch_seconds, keep_where


class Star(NamedTuple):
    users: DataFrame
    sessions: DataFrame
    events: DataFrame
    rejects: DataFrame


def checked(records: DataFrame) -> DataFrame:
    """Records with their canonical session id as `session_uuid`, null when it is not a UUID."""
    return records.withColumn("session_uuid", canonical_uuid(F.col("session_id")))


def event_info(records: DataFrame, *keep: str) -> DataFrame:
    """Epoch time, type, browser and device of each record; the last two may be absent."""
    kind = records.schema["timestamp"].dataType
    optional = [F.col(c) if c in records.columns else F.lit(None).cast("string").alias(c) for c in ("browser", "device")]
    return records.select(
        *keep, epoch_seconds(F.col("timestamp"), kind).alias("timestamp"), "event_type", *optional
    )


def new_users(valid: DataFrame, users: DataFrame) -> DataFrame:
    return valid.select("user_id").distinct().join(users, "user_id", "left_anti")


def new_sessions(valid: DataFrame, sessions: DataFrame, order: Column) -> DataFrame:
    """Sessions not known yet; the first record by `order` fixes user, browser and device."""
    first = F.min_by(F.struct("user_id", "browser", "device"), order).alias("s")
    return (
        valid.groupBy(F.col("session_uuid").alias("session_id"))
        .agg(first)
        .select("session_id", "s.user_id", "s.browser", "s.device")
        .join(sessions, "session_id", "left_anti")
    )


def event_facts(valid: DataFrame, event_key: Column) -> DataFrame:
    """One fact per valid record, an empty type included."""
    facts = event_info(valid.withColumn("event_id", event_key), "event_id", "session_uuid")
    return facts.select(
        "event_id", F.col("session_uuid").alias("session_id"), "timestamp", F.col("event_type").alias("type")
    )


def file_event_key() -> Column:
    """A stable event key for records scanned from files: 128 bits of file and row, so that keys do not collide."""
    return F.md5(F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index")))


def process_records(
    records: DataFrame, users: DataFrame, sessions: DataFrame, order: Column, event_key: Column
) -> Star:
    """Split records into rows to append to the three tables and the records left out."""
    optional = {c: F.lit(None).cast("string") for c in ("browser", "device") if c not in records.columns}
    rows = checked(records.withColumns(optional) if optional else records)
    valid = keep_where(rows, F.col("session_uuid").isNotNull())
    return Star(
        new_users(valid, users),
        new_sessions(valid, sessions, order),
        event_facts(valid, event_key),
        keep_where(rows, F.col("session_uuid").isNull()).drop("session_uuid"),
    )


def skipped_sessions(rejects: DataFrame) -> DataFrame:
    """How often each invalid session id was left out."""
    return rejects.groupBy("session_id").agg(F.count("*").alias("records"))


def skipped_count(rejects: DataFrame) -> DataFrame:
    return rejects.agg(F.count("*").alias("skipped"))
