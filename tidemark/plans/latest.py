"""The last row, or the last few rows, of every key."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.joins import own_stage

#: The order is cut into two to the power of this many cells at most.
_CELL_BITS = 16

_FIXED_WIDTH = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
    T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def latest_rows(rows: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order_cols``, which are not null.

    An aggregate, not a window: each task reduces its rows to one per key before
    anything is shuffled, so a hot key costs its reducer one row per task.

    If every other column has a fixed width and the order is one number (or a time and
    a number, put together into one), each column is picked on its own and Spark runs
    a hash aggregate without sorting; this needs an order that is unique within the
    key, like an arrival number.  Otherwise the columns travel as one struct.
    """
    key_cols = list(key_cols)
    others = [c for c in rows.columns if c not in key_cols]
    order = _ordering(rows, order_cols)
    narrow = order is not None and all(
        isinstance(rows.schema[c].dataType, _FIXED_WIDTH) for c in others
    )
    if narrow and others:
        picks = [
            F.max(c).alias(c) if [c] == list(order_cols) else F.max_by(c, order).alias(c)
            for c in others
        ]
        return rows.groupBy(*key_cols).agg(*picks).select(*rows.columns)
    last = F.max_by(F.struct(*others), F.struct(*order_cols)).alias("_last")
    found = rows.groupBy(*key_cols).agg(last)
    return found.select(
        *[F.col(c) if c in key_cols else F.col(f"_last.{c}").alias(c) for c in rows.columns]
    )


def newest_rows(
    rows: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str], n: int, spread: bool = False
) -> DataFrame:
    """The ``n`` rows of every key with the greatest ``order_cols``.

    One plan for every ``n``.  Spark turns ``row_number() <= n`` into a limit within each
    task before the shuffle, up to its own threshold for ``n``; beyond that the rows of a
    key are sorted together, on disk where memory does not do.  With ``spread`` they are not:
    for two more passes, the n-th row of each key is looked for first (see :func:`_selected`).
    The order is one whole number then.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    if not spread:
        return _numbered(rows, key_cols, order_cols, F.lit(n))
    if len(order_cols) != 1 or not isinstance(rows.schema[order_cols[0]].dataType, T.IntegralType):
        raise TypeError(f"{list(order_cols)} is not one whole number")
    return _selected(rows, list(key_cols), order_cols[0], n)


def _numbered(rows: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str], most: Column) -> DataFrame:
    number = F.row_number().over(
        Window.partitionBy(*key_cols).orderBy(*[F.col(c).desc() for c in order_cols])
    )
    return rows.withColumn("_rank", number).where(F.col("_rank") <= most).drop("_rank")


def _selected(rows: DataFrame, key_cols: list[str], order: str, n: int) -> DataFrame:
    """The newest ``n`` by distributed selection.

    The order's range is cut into cells of equal width.  The numbers of rows by key and cell
    (an aggregate) say in which cell of a key its n-th row lies; the rows of later cells are
    among the newest, those of earlier ones are not, and only the rows of that one cell are
    numbered.  A key's rows come together in no task unless they lie in one cell, as they may
    where the order has gaps thousands of times as wide as its rows' span.
    """
    low, high = (f(order).cast("double") for f in (F.min, F.max))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(high - low + 1)) - _CELL_BITS).cast("int")
    shift = rows.agg(F.coalesce(bits, F.lit(0))).scalar()
    cell = F.call_function("shiftright", F.col(order).cast("long"), shift)
    # Rows without a place in the order come last.
    cell = F.coalesce(cell, F.lit(-(1 << 63)).cast("long")).alias("_cell")
    counts = rows.select(*key_cols, cell).groupBy(*key_cols, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    cells = F.sort_array(F.collect_list(F.struct("_cell", "_n")), asc=False)

    def go_on(seen: Column, x: Column) -> Column:
        reached = seen["above"] + x["_n"] >= n
        return F.when(seen["cell"].isNotNull(), seen).otherwise(
            F.struct(
                F.when(reached, seen["above"]).otherwise(seen["above"] + x["_n"]).alias("above"),
                F.when(reached, x["_cell"]).alias("cell"),
            )
        )

    start = F.struct(F.lit(0).cast("long").alias("above"), F.lit(None).cast("long").alias("cell"))
    edges = counts.groupBy(*key_cols).agg(F.aggregate(cells, start, go_on).alias("_edge"))
    edges = own_stage(edges).select(
        *[F.col(c).alias(f"_key_{c}") for c in key_cols],
        F.col("_edge.cell").alias("_edge"),
        (F.lit(n) - F.col("_edge.above")).alias("_left"),
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in key_cols])
    placed = rows.select("*", cell).join(edges, same)
    whole = placed.where(F.col("_edge").isNull() | (F.col("_cell") > F.col("_edge"))).select(*rows.columns)
    edge = _numbered(placed.where(F.col("_cell") == F.col("_edge")), key_cols, [order], F.col("_left"))
    return whole.unionByName(edge.select(*rows.columns))


def _ordering(rows: DataFrame, order_cols: Sequence[str]) -> Column | None:
    """The order as one number, if it is a number or a time followed by a whole number."""
    if len(order_cols) == 1:
        return F.col(order_cols[0])
    if len(order_cols) != 2:
        return None
    first, second = (rows.schema[c].dataType for c in order_cols)
    if not isinstance(first, (T.TimestampType, T.TimestampNTZType)):
        return None
    if not isinstance(second, T.IntegralType):
        return None
    # Microseconds times 2^64 leave room for any whole number and fit into 38 digits.
    micros = F.unix_micros(F.col(order_cols[0]).cast("timestamp")).cast("decimal(18,0)")
    scaled = micros * F.lit(str(1 << 64)).cast("decimal(20,0)")
    return (scaled + F.col(order_cols[1]).cast("decimal(19,0)")).cast("decimal(38,0)")
