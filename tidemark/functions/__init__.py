"""Column expressions: keys, times, payload text.  All JVM-side."""

from tidemark.functions.keys import KEY_LAYOUTS, key_text, key_tail, prefix_end, stable_id
from tidemark.functions.patterns import glob_match, like_match
from tidemark.functions.payload import (
    METADATA_READ_RULES,
    METADATA_WRITE_RULES,
    integral_offset,
    json_string,
    metadata_on_read,
    metadata_on_write,
    offset_from,
    payload_text,
)
from tidemark.functions.times import TIME_FORMATS, format_time, iso_text, moment, parse_time

__all__ = [
    "KEY_LAYOUTS",
    "METADATA_READ_RULES",
    "METADATA_WRITE_RULES",
    "TIME_FORMATS",
    "format_time",
    "glob_match",
    "integral_offset",
    "iso_text",
    "json_string",
    "key_tail",
    "key_text",
    "like_match",
    "metadata_on_read",
    "metadata_on_write",
    "moment",
    "offset_from",
    "parse_time",
    "payload_text",
    "prefix_end",
    "stable_id",
]
