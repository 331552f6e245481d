"""Text rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for "no value", compared after trimming and lower-casing.
MISSING_TOKENS = ("", "nan", "none", "null")

# Every code point Unicode calls white space; SQL TRIM alone takes only the blank.
_WHITESPACE = "".join(
    map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)))
) + "".join(map(chr, (0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

_UUID = r"\A" + "".join(r"([0-9a-f]{%d})" % n for n in (8, 4, 4, 4, 12)) + r"\z"

# Fixed value: longest error text a task or run keeps.
ERROR_LENGTH = 500


def strip_text(c: Column) -> Column:
    return F.btrim(c, F.lit(_WHITESPACE))


def is_missing(c: Column) -> Column:
    """Null, or a text that only says that there is no value. Never null itself."""
    return c.isNull() | F.lower(strip_text(c)).isin(*MISSING_TOKENS)


def truncate_error(c: Column) -> Column:
    return F.left(c, F.lit(ERROR_LENGTH))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def canonical_uuid(c: Column) -> Column:
    """UUID text (with or without hyphens, braces, urn:uuid:) in lower-case canonical form.

    Null for anything else.
    """
    bare = F.replace(F.replace(c, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    bare = F.replace(F.btrim(bare, F.lit("{}")), F.lit("-"), F.lit(""))
    low = F.lower(bare)
    return F.nullif(F.regexp_replace(low, _UUID, "$1-$2-$3-$4-$5"), low)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Float NaN becomes null in every float column."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.withColumns({n: F.when(~F.isnan(df[n]), df[n]) for n in floats})


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """The rows for which the condition holds.

    For conditions on columns that are costly to compute: a filter would be pushed below the
    projections that compute them, and they would be computed once more above it.
    """
    return df.select("*", F.explode(F.when(condition, F.array(F.lit(True)))).alias("_kept")).drop("_kept")


#: Into so many parts the lookup keys of a mart are dealt.
KEY_PARTS = 256


def key_part(key: Column | str) -> Column:
    """The part of a lookup key: the same in what deals rows to files, in commit entries and in lookups."""
    return F.pmod(F.xxhash64(key), F.lit(KEY_PARTS)).cast("int")
