"""Checks of how large a side of a join is before it is broadcast."""

from collections.abc import Sequence

from pyspark.sql import DataFrame


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own estimate of ``df`` is within its broadcast threshold.

    The same numbers the planner compares; nothing is executed.  A threshold of
    -1 (broadcast off) gives ``False``.
    """
    state = df.sparkSession._jsparkSession.sessionState()
    threshold = int(state.conf().autoBroadcastJoinThreshold())
    if threshold < 0:
        return False
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= threshold


def narrow_to_keys(table: DataFrame, keys: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """``table`` cut down to the rows a later join with ``keys`` can use.

    A left join cannot broadcast its left side, so looking up a few keys would
    shuffle the whole table.  When the keys are small they are sent to the table
    instead and only the rows found travel.  When they are not, or when the table
    itself can be broadcast, it is returned as it is and the later join does it all.
    """
    if fits_broadcast(table) or not fits_broadcast(keys):
        return table
    return table.join(keys.select(*key_cols), list(key_cols), "left_semi")
