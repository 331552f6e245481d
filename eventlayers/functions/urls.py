"""URL split into authority, path and path segments.

`parse_url` is not used: under ANSI mode it raises on texts that are not strict
URIs, it cuts the port off the host and it keeps `;parameters` in the path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Schemes whose last path segment may carry ";parameters".
_PARAMETER_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps",
    "sip", "sips", "mms", "sftp", "tel",
)

_CONTROL_AND_BLANK = "".join(map(chr, range(0x21)))
_TO_END = 1 << 30
_SCHEME = r"\A([a-zA-Z][a-zA-Z0-9+.\-]*):"


def url_hierarchy(url: Column) -> Column:
    """The text before query and fragment, without leading controls and inner line breaks."""
    trimmed = F.ltrim(url, F.lit(_CONTROL_AND_BLANK))
    broken = trimmed.contains("\t") | trimmed.contains("\r") | trimmed.contains("\n")
    clean = F.when(broken, F.translate(trimmed, "\t\r\n", "")).otherwise(trimmed)
    return F.substring_index(F.substring_index(clean, "#", 1), "?", 1)


def with_url_parts(df: DataFrame, url: str = "page_url") -> DataFrame:
    """Adds page_host, page_path and the first three path segments.

    Host: the authority as written, with user info, port and letter case; '' when there is
    none. Path: without query, fragment and the `;parameters` of its last segment. Segments:
    the non-empty ones, null beyond the last.

    Each step is its own projection, so that a text used twice is computed once.
    """
    hierarchy, rest, path, parts = (F.col(c) for c in ("_hierarchy", "_rest", "page_path", "_parts"))
    located = rest.startswith("//")
    host = F.when(located, F.substring_index(F.substring(rest, 3, _TO_END), "/", 1)).otherwise(F.lit(""))
    full_path = F.when(located, F.substr(rest, F.length("page_host") + 3)).otherwise(rest)
    scheme = F.lower(F.regexp_extract(hierarchy, _SCHEME, 1))
    takes_parameters = path.contains(";") & scheme.isin(*_PARAMETER_SCHEMES)
    return (
        df.withColumn("_hierarchy", url_hierarchy(F.col(url)))
        .withColumn("_rest", F.regexp_replace(hierarchy, _SCHEME, ""))
        .withColumn("page_host", F.when(rest.isNotNull(), host))
        .withColumn("page_path", full_path)
        .withColumn(
            "page_path",
            F.when(takes_parameters, F.regexp_replace(path, r";[^/]*\z", "")).otherwise(path),
        )
        .withColumn("_parts", F.array_remove(F.split(path, "/"), ""))
        .withColumns(
            {n: F.get(parts, F.lit(i)) for i, n in enumerate(("page_section", "page_category", "page_item"))}
        )
        .drop("_hierarchy", "_rest", "_parts")
    )


_GROUP = "[0-9A-Fa-f]{1,4}"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_LAST_AS_V4 = rf"(?<=:){_OCTET}(?:\.{_OCTET}){{3}}\z"
_WHOLE_V6 = rf"\A{_GROUP}(?::{_GROUP}){{7}}\z"
_SHORT_V6 = rf"\A(?:{_GROUP}(?::{_GROUP})*)?::(?:{_GROUP}(?::{_GROUP})*)?\z"
_FUTURE = r"\Av[0-9A-Fa-f]+\..+\z"


def _is_ip_literal(text: Column) -> Column:
    """An IPv6 address, with or without a zone, or one of a future version (`v<hex>.<text>`)."""
    zone = F.substring_index(text, "%", 1)
    zoned = ~text.contains("%") | text.rlike(r"\A[^%]*%[^%]+\z")
    address = F.regexp_replace(zone, _LAST_AS_V4, "0:0")
    groups = F.size(F.array_remove(F.split(address, ":"), ""))
    v6 = address.rlike(_WHOLE_V6) | (address.rlike(_SHORT_V6) & (groups <= 7))
    return F.when(text.startswith("v"), text.rlike(_FUTURE)).otherwise(zoned & v6)


def has_valid_host(url: Column, host: Column) -> Column:
    """False for a null URL, for a bracket without its partner, and where the first brackets hold no IP literal."""
    opens, closes = host.contains("["), host.contains("]")
    inside = F.substring_index(F.substr(host, F.instr(host, "[") + 1), "]", 1)
    return url.isNotNull() & ((~opens & ~closes) | (opens & closes & _is_ip_literal(inside)))
