"""Current state and counts from logs and tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import key_tail
from tidemark.plans import latest_rows, newest_rows
from tidemark.schema import KEY_COLS


def latest_by_arrival(
    log: DataFrame, key_cols: Sequence[str] = KEY_COLS, seq: str = "seq"
) -> DataFrame:
    """The last event of every key in order of arrival.

    Select the columns you need before calling: with fixed-width columns only,
    Spark aggregates by hash instead of sorting.
    """
    return latest_rows(log, key_cols, [seq])


def latest_by_version(
    log: DataFrame,
    key_cols: Sequence[str] = KEY_COLS,
    version: str = "updated_at",
    seq: str = "seq",
) -> DataFrame:
    """The event with the highest version of every key, however late it arrived.

    Of events with the same version the last to arrive wins.
    """
    return latest_rows(log, key_cols, [version, seq])


def keep_last_n(
    log: DataFrame,
    key_cols: Sequence[str] = KEY_COLS,
    n: int = 1,
    seq: str = "seq",
    spread: bool = False,
) -> DataFrame:
    """The newest ``n`` events of every key: a bounded queue that drops its head.

    Set ``spread`` for an ``n`` above Spark's ``windowGroupLimitThreshold`` (1,000) where a key
    may have more events than one task should sort.
    """
    return newest_rows(log, key_cols, [seq], n, spread)


def count_checkpoints(table: DataFrame, by: str | Sequence[str] | None = None) -> DataFrame:
    """Number of rows, in all or per group."""
    groups = [] if by is None else [by] if isinstance(by, str) else list(by)
    return table.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_checkpoints"))


def list_streams(table: DataFrame, column: str = "stream_id") -> DataFrame:
    """The streams that have a row."""
    return table.select(column).distinct()


def list_subkeys(
    table: DataFrame,
    stream_id: str,
    column: str = "partition",
    key: str | None = None,
    prefix: str = "",
    stream_col: str = "stream_id",
) -> DataFrame:
    """The sub-keys (partitions, named keys) of one stream, without repeats.

    Either they are in ``column``, or ``key`` holds storage keys of the form
    ``prefix + stream_id + ':' + sub-key`` and they are cut out of it.
    """
    if key is None:
        return table.where(F.col(stream_col) == stream_id).select(column).distinct()
    lead = f"{prefix}{stream_id}:"
    return (
        table.where(F.col(key).startswith(lead))
        .select(key_tail(key, lead).alias(column))
        .distinct()
    )


def duplicate_keys(table: DataFrame, key_cols: Sequence[str] = KEY_COLS) -> DataFrame:
    """Keys with more than one row, and how many they have."""
    return (
        table.groupBy(*key_cols)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )
