"""Time rules. Results are wall-clock UTC (TIMESTAMP_NTZ), whatever the session zone is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The form nearly every row has: extended, seconds given, UTC or no offset.
_PLAIN = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|\+00:00)?\z"

# Calendar date in extended or basic form; then, after any one character, a time of one to
# three parts with an optional fraction; then an optional offset of one to three parts.
_ISO = (
    r"\A(?<y>\d{4})(?<a>-?)(?<m>\d{2})\k<a>(?<d>\d{2})"
    r"(?:[\s\S](?<h>\d{2})(?:(?<b>:?)(?<i>\d{2})(?:\k<b>(?<s>\d{2})(?:[.,](?<f>\d+))?)?)?"
    r"(?:Z|(?<sign>[+-])(?<oh>[01]\d|2[0-3])(?:(?<c>:?)(?<oi>[0-5]\d)(?:\k<c>(?<os>[0-5]\d))?)?)?)?\z"
)
# Time and offset of a match, apart; a part left out leaves a gap to fill with zeros.
_APART = "${y}-${m}-${d} ${h}:${i}:${s}.${f}0|${sign}${oh}:${oi}:${os}"
_GAP = r"(?<=[ :|])(?=[:.])|(?<=:)\z"


def iso_parts(c: Column) -> Column:
    """[time, offset] of a text that is ISO-8601 but not in the usual form, else null."""
    matched = ~c.rlike(_PLAIN) & c.rlike(_ISO)
    apart = F.regexp_replace(F.regexp_replace(c, _ISO, _APART), _GAP, "00")
    return F.when(matched, F.split(apart, r"\|"))


def iso_timestamp(c: Column, parts: Column | None = None) -> Column:
    """ISO-8601 calendar text to TIMESTAMP_NTZ in UTC; null for anything else.

    A text without an offset is taken as UTC. ISO week dates are not accepted.
    Callers over whole layers give `parts`, a column of `iso_parts(c)`, so it is computed once.
    """
    parts = iso_parts(c) if parts is None else parts
    wall = F.get(parts, F.lit(0)).try_cast("timestamp_ntz")
    offset = F.get(parts, F.lit(1)).try_cast("interval hour to second")
    parsed = F.when(parts.isNotNull(), wall - offset).when(c.rlike(_PLAIN), c.try_cast("timestamp_ntz"))
    return F.when(c >= "0001", parsed)


def epoch_seconds(c: Column, data_type: T.DataType) -> Column:
    """Whole epoch seconds, cut towards zero, of a text or timestamp.

    Any other type has no time to convert and gives null.
    """
    if isinstance(data_type, T.StringType):
        wall = iso_timestamp(c)
    elif isinstance(data_type, T.TimestampNTZType):
        wall = c
    elif isinstance(data_type, T.TimestampType):
        return _whole_seconds(F.unix_micros(c))
    else:
        return F.lit(None).cast("long")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return _whole_seconds(F.timestamp_diff("MICROSECOND", epoch, wall))


def _whole_seconds(micros: Column) -> Column:
    return ((micros - micros % 1_000_000) / 1_000_000).cast("long")


def dated_object_name(ts: Column, prefix: str = "events") -> Column:
    """`YYYY/MM/DD/<prefix>_YYYYMMDD_HHMMSS_micros.parquet`."""
    return F.concat(
        F.date_format(ts, "yyyy/MM/dd/"),
        F.lit(prefix + "_"),
        F.date_format(ts, "yyyyMMdd_HHmmss_SSSSSS"),
        F.lit(".parquet"),
    )
