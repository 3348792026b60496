"""Changes to tables and logs.

Nothing is changed in place: each operator gives the new contents, to be written
as a new version.  A key may be named several times in ``changes``; the last
one by ``seq`` counts.  A change without its key stops the query; a row of the table
without one is nobody's and stays.

There is one plan for every size.  Spark alone decides whether a side is broadcast.
"""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import moment
from tidemark.operators.state import latest_by_arrival
from tidemark.plans import join_on_keys, latest_rows
from tidemark.schema import DELETE, KEY_COLS, SAVE


def upsert(
    table: DataFrame,
    changes: DataFrame,
    key_cols: Sequence[str] = KEY_COLS,
    seq: str = "seq",
) -> DataFrame:
    """Put whole rows: a changed key's old row is gone, columns not given are null.

    All old rows of a changed key go, also if the table repeats it.
    """
    key_cols = list(key_cols)
    final = _last_change(changes, key_cols, seq, table.columns)
    kept = join_on_keys(table, _keys_of(changes, key_cols), key_cols, "left_anti")
    return kept.unionByName(final, allowMissingColumns=True).select(*table.columns)


def merge_columns(
    table: DataFrame,
    changes: DataFrame,
    cols: Sequence[str],
    key_cols: Sequence[str] = KEY_COLS,
    seq: str = "seq",
) -> DataFrame:
    """Put the columns ``cols`` of changed keys; their other columns keep the old value.

    A null in the changes replaces the old value.  New keys get a row with nulls in
    the other columns.  Every row of a key that the table repeats is changed.
    """
    key_cols, cols = list(key_cols), list(cols)
    unknown = [c for c in cols if c not in changes.columns or c not in table.columns]
    if unknown:
        raise ValueError(f"columns {unknown} are not in both the table and the changes")
    final = _last_change(changes, key_cols, seq, [*key_cols, *cols])
    merged = [_changed_or_old(c) if c in cols else F.col(c) for c in table.columns]
    updated = join_on_keys(table, _marked(final, key_cols, cols), key_cols, "left").select(*merged)
    # New keys are what the table's key columns, read alone, do not hold.
    added = join_on_keys(final, table.select(*key_cols), key_cols, "left_anti")
    return updated.unionByName(added, allowMissingColumns=True).select(*table.columns)


def delete_keys(
    table: DataFrame, keys: DataFrame, key_cols: Sequence[str] = KEY_COLS
) -> DataFrame:
    """The table without the given keys; keys it does not have change nothing."""
    return join_on_keys(table, keys.select(*key_cols), key_cols, "left_anti")


def delete_report(
    table: DataFrame, keys: DataFrame, key_cols: Sequence[str] = KEY_COLS
) -> DataFrame:
    """For every requested key, whether there was a row to delete."""
    key_cols = list(key_cols)
    # Only what is asked for leaves the table.
    held = join_on_keys(table.select(*key_cols), keys.select(*key_cols).distinct(), key_cols, "left_semi")
    marked = held.distinct().withColumn("_found", F.lit(True))
    return join_on_keys(keys.select(*key_cols), marked, key_cols, "left").select(
        *key_cols, F.col("_found").isNotNull().alias("deleted")
    )


def delete_history(
    log: DataFrame,
    keys: DataFrame,
    key_cols: Sequence[str] = KEY_COLS,
    start=None,
    stop=None,
    ts: str = "updated_at",
) -> DataFrame:
    """The log without all events of the given keys, from ``start`` up to ``stop``.

    Both ends are included; an end left out is open.
    """
    condition = None
    if start is not None:
        condition = F.col(ts) >= moment(start)
    if stop is not None:
        until = F.col(ts) <= moment(stop)
        condition = until if condition is None else condition & until
    return join_on_keys(log, keys.select(*key_cols), key_cols, "left_anti", condition)


def clear(table: DataFrame, value=None, column: str = "pipeline_id") -> DataFrame:
    """An empty table, or the table without the rows whose ``column`` is ``value``.

    Rows that hold null there are not of that group and stay.
    """
    if value is None:
        return table.where(F.lit(False))
    return table.where(~F.col(column).eqNullSafe(F.lit(value)))


def update_offset(
    table: DataFrame,
    changes: DataFrame,
    as_of,
    key_cols: Sequence[str] = KEY_COLS,
    seq: str = "seq",
) -> DataFrame:
    """Change offset and update time of rows that are there; all else stays.

    Changes for unknown keys have no effect.
    """
    key_cols = list(key_cols)
    offsets = [c for c in ("offset_json", "offset_num") if c in table.columns]
    final = _last_change(changes, key_cols, seq, [*key_cols, *offsets])
    new = _marked(final, key_cols, offsets)
    columns = [_changed_or_old(c) if c in offsets else F.col(c) for c in table.columns]
    if "updated_at" in table.columns:
        now = moment(as_of).cast(table.schema["updated_at"].dataType)
        columns[table.columns.index("updated_at")] = (
            F.when(F.col("_changed"), now).otherwise(F.col("updated_at")).alias("updated_at")
        )
    return join_on_keys(table, new, key_cols, "left").select(*columns)


def replace_all(
    table: DataFrame,
    changes: DataFrame,
    key_cols: Sequence[str] = KEY_COLS,
    seq: str = "seq",
) -> DataFrame:
    """Remove every copy of a changed key from a table that may repeat keys, then put one."""
    return upsert(table, changes, key_cols, seq)


def compact_log(
    log: DataFrame, key_cols: Sequence[str] = KEY_COLS, seq: str = "seq", op: str = "op"
) -> DataFrame:
    """The last event of every key, without the keys whose last event is a delete.

    Select the columns you need before calling: with fixed-width columns beside key
    and ``op``, Spark aggregates by hash instead of sorting.
    """
    # A flag travels through the aggregate in place of the text; what is left are saves.
    last = latest_by_arrival(log.withColumn(op, F.col(op) == DELETE), key_cols, seq)
    return last.where(~F.col(op)).withColumn(op, F.lit(SAVE))


def _last_change(
    changes: DataFrame, key_cols: Sequence[str], seq: str, columns: Sequence[str]
) -> DataFrame:
    """One change per key, with those of ``columns`` that the changes have.

    Changes without an arrival number hold each key once already.
    """
    changes = _with_keys(changes, key_cols)
    wanted = [c for c in columns if c in changes.columns]
    if seq not in changes.columns:
        return changes.select(*wanted)
    rows = changes.select(*wanted, *([] if seq in wanted else [seq]))
    return latest_rows(rows, key_cols, [seq]).select(*wanted)


def _keys_of(rows: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """The keys alone: an aggregate by hash, whatever the other columns are."""
    return _with_keys(rows, key_cols).select(*key_cols).distinct()


def _with_keys(rows: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """The rows as they are, checked to have their keys; a filter, so bucketing stays."""
    lacking = reduce(or_, [F.col(c).isNull() for c in key_cols])
    message = F.lit("a change without a key: one of " + ", ".join(key_cols) + " is null")
    return rows.where(F.when(lacking, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def _marked(changes: DataFrame, key_cols: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The changes with ``cols`` under other names (null where they lack one) and a mark."""
    values = [
        (F.col(c) if c in changes.columns else F.lit(None)).alias(f"_new_{c}") for c in cols
    ]
    return changes.select(*key_cols, *values, F.lit(True).alias("_changed"))


def _changed_or_old(column: str) -> Column:
    # Not coalesce: a null in the changes replaces the old value.
    return F.when(F.col("_changed"), F.col(f"_new_{column}")).otherwise(F.col(column)).alias(column)
