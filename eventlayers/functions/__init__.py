"""Column expressions: text, URL and time rules. All JVM-side, no UDFs."""

from eventlayers.functions.text import (
    KEY_PARTS,
    basename,
    canonical_uuid,
    is_missing,
    keep_where,
    key_part,
    nan_to_null,
    strip_text,
    truncate_error,
)
from eventlayers.functions.times import (
    dated_object_name,
    epoch_seconds,
    iso_parts,
    iso_timestamp,
)
from eventlayers.functions.urls import has_valid_host, url_hierarchy, with_url_parts

__all__ = [
    "KEY_PARTS",
    "basename",
    "canonical_uuid",
    "dated_object_name",
    "epoch_seconds",
    "has_valid_host",
    "is_missing",
    "iso_parts",
    "iso_timestamp",
    "keep_where",
    "key_part",
    "nan_to_null",
    "strip_text",
    "truncate_error",
    "url_hierarchy",
    "with_url_parts",
]
