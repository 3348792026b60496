"""Equi joins on keys."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_on_keys(
    left: DataFrame,
    right: DataFrame,
    key_cols: Sequence[str],
    how: str,
    condition: Column | None = None,
) -> DataFrame:
    """``left`` joined with ``right`` on ``key_cols``; a key with a null matches nothing.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``; the key columns come
    from ``left``.  ``condition`` is a further predicate over columns of both sides,
    which share no names but the keys.

    Spark picks the algorithm by the sizes it finds.  None of these joins needs the
    rows of a key together, so adaptive execution splits the partitions in which a hot
    key of ``left`` ends up, also where ``right`` is an aggregate (see :func:`own_stage`).
    """
    right = own_stage(right)
    renamed = right.select(
        *[F.col(c).alias(f"_right_{c}") if c in key_cols else F.col(c) for c in right.columns]
    )
    same = [left[c] == renamed[f"_right_{c}"] for c in key_cols]
    on = reduce(and_, same if condition is None else [*same, condition])
    return left.join(renamed, on, how).drop(*[f"_right_{c}" for c in key_cols])


def own_stage(rows: DataFrame) -> DataFrame:
    """``rows``, dealt out anew where they come from an aggregate.

    An aggregate leaves its rows partitioned by its key.  A join on that key would take them
    as they are: the stage of the join would then be the aggregate's, and Spark splits the
    partition of a hot key on the other side only in a stage that has nothing but the join's
    own exchanges.  The rows of an aggregate are one per key, so dealing them costs little
    beside the side that has many per key.
    """
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    return rows.hint("rebalance") if "Aggregate [" in plan else rows
