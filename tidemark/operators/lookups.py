"""Lookups of many keys and resuming a source.

Key lists should hold each key once; a key asked for twice is answered twice.  A key
with a null matches nothing.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import narrow_to_keys, own_stage
from tidemark.schema import KEY_COLS


def load_many(
    table: DataFrame, keys: DataFrame, key_cols: Sequence[str] = KEY_COLS
) -> DataFrame:
    """The row of every key in ``keys``; nulls for keys without one."""
    key_cols = list(key_cols)
    found = narrow_to_keys(table, keys, key_cols)
    return keys.select(*key_cols).join(found, key_cols, "left").select(*table.columns)


def existing(
    table: DataFrame, keys: DataFrame, key_cols: Sequence[str] = KEY_COLS
) -> DataFrame:
    """The keys that have a row.  Only key columns of the table are read."""
    found = narrow_to_keys(table.select(*key_cols), keys, key_cols)
    return keys.join(found, list(key_cols), "left_semi")


def missing(
    table: DataFrame, keys: DataFrame, key_cols: Sequence[str] = KEY_COLS
) -> DataFrame:
    """The keys that have no row.  Only key columns of the table are read."""
    found = narrow_to_keys(table.select(*key_cols), keys, key_cols)
    return keys.join(found, list(key_cols), "left_anti")


def resume(
    source: DataFrame,
    table: DataFrame,
    offset_col: str,
    key_cols: Sequence[str] = KEY_COLS,
) -> DataFrame:
    """The source records that come after their stream's offset.

    Strictly after: the offset is set once a record has been dealt with.  Streams
    without a row, or with a row that holds no offset, start at the beginning.
    Offsets must be numbers; text has no order and is refused.

    ``table`` has one row per key.  Adaptive execution splits a stream that holds a large
    part of the source over several tasks, also where the table is an aggregate.
    """
    if not isinstance(source.schema[offset_col].dataType, T.IntegralType):
        raise TypeError(f"offset column {offset_col!r} is not a whole number and has no order")
    position = [F.col("offset_num").alias("_read_up_to")]
    if "offset_json" in table.columns:
        position.append(F.nullif("offset_json", F.lit("null")).alias("_offset_text"))
    offsets = table.select(*key_cols, *position)
    if not source.isStreaming:
        offsets = own_stage(offsets)
    joined = source.join(offsets, list(key_cols), "left")
    from_start = F.lit(True)
    if "offset_json" in table.columns:
        refusal = F.concat(F.lit("no order to resume after offset "), F.col("_offset_text"))
        from_start = F.when(F.col("_offset_text").isNull(), True).otherwise(F.raise_error(refusal))
    unread = F.when(
        F.col("_read_up_to").isNotNull(), F.col(offset_col) > F.col("_read_up_to")
    ).otherwise(from_start)
    return joined.where(unread).select(*source.columns)
