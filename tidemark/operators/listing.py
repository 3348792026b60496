"""Whole-table listings, ordered and capped ones."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans import with_position


def list_all(table: DataFrame) -> DataFrame:
    """Every row of every pipeline."""
    return table


def ordered_list(
    table: DataFrame, order: Sequence[str | Column], position: str | None = None
) -> DataFrame:
    """The table in ``order``; with ``position``, each row's place in a column of that name.

    Sorting is distributed in both cases.  For positions that are the same on every
    run, ``order`` must end with columns that make it unique.
    """
    columns = _columns(order)
    if position is None:
        return table.orderBy(*columns)
    return with_position(table, columns, position)


def limited_list(table: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in ``order``; each task passes on ``n`` rows at most."""
    return table.orderBy(*_columns(order)).limit(n)


def _columns(order: Sequence[str | Column]) -> list[Column]:
    if not order:
        raise ValueError("an order is required: without one the rows would be arbitrary")
    return [F.col(c) if isinstance(c, str) else c for c in order]
