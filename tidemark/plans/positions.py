"""Position of every row in a total order, without bringing the rows together."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scratch import scratch_path

#: Fixed value: ``monotonically_increasing_id`` keeps the row number within a
#: partition in its lower 33 bits.
_ROW_BITS = (1 << 33) - 1


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with its rows numbered from 1 in ``order``.

    ``row_number`` over the whole table would move every row to one task.  Here
    the table is range-partitioned and sorted, written once, and the number of a
    row is its place in its partition plus the sizes of the partitions before it.
    Only those sizes, one number per partition, are summed up in one place.
    ``order`` must be total for the numbers to be repeatable.
    """
    path = scratch_path(df.sparkSession, "positions")
    (
        df.orderBy(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
        .write.parquet(path)
    )
    rows = df.sparkSession.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    # One row per partition of the sort, a few thousand at most.
    numbered = rows.join(F.broadcast(starts), "_part")
    return numbered.select(
        *df.columns, (F.col("_before") + F.col("_row") + F.lit(1)).alias(name)
    )
