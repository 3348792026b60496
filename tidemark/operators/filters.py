"""Row filters.  Each is one predicate that Spark can push into the scan."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import glob_match, like_match


def by_key(df: DataFrame, **key) -> DataFrame:
    """The row of one key: ``by_key(df, pipeline_id='p', stream_id='s')``."""
    if not key:
        raise ValueError("name at least one key column")
    for column, value in key.items():
        df = df.where(F.col(column) == value)
    return df


def by_group(df: DataFrame, column: str, value) -> DataFrame:
    """All rows of one pipeline, or of one stream."""
    return df.where(F.col(column) == value)


def by_prefix(df: DataFrame, prefix: str, key: str = "key") -> DataFrame:
    """Rows whose key starts with ``prefix``, taken literally."""
    return df.where(F.col(key).startswith(prefix))


def by_key_range(df: DataFrame, low: str, high: str | None = None, key: str = "key") -> DataFrame:
    """Rows with ``low <= key < high``; without ``high`` the range is open above."""
    found = F.col(key) >= low
    if high is not None:
        found = found & (F.col(key) < high)
    return df.where(found)


def by_pattern(df: DataFrame, pattern: str, kind: str = "like", key: str = "key") -> DataFrame:
    """Rows whose key matches: ``like`` (``\\`` escapes), ``glob`` or ``contains``."""
    column = F.col(key)
    if kind == "like":
        return df.where(like_match(column, pattern))
    if kind == "glob":
        return df.where(glob_match(column, pattern))
    if kind == "contains":
        return df.where(column.contains(pattern))
    raise ValueError(f"unknown pattern kind {kind!r}; one of ('like', 'glob', 'contains')")


def by_payload_field(df: DataFrame, field: str, value: str, data: str | Column = "data") -> DataFrame:
    """Rows whose JSON payload has ``value`` in a top-level ``field``.

    Every payload is read.  Keep keys as columns and use :func:`by_group` instead
    where there is a choice.
    """
    if "'" in field:
        raise ValueError(f"field name {field!r} has a quote in it")
    column = F.col(data) if isinstance(data, str) else data
    return df.where(F.get_json_object(column, f"$['{field}']") == value)
