"""Op 8: a reproducible shuffle into shards whose rows and slots can be computed.

Every row gets a global row number (its place in the order of id, then content). A Feistel
network permutes the row numbers; values that fall outside the table are permuted again
(cycle walking), so the result is a permutation of ``0 .. n - 1``. Place ``p`` goes to shard
``p mod shards``, slot ``p div shards``: shard sizes differ by one row at most, slots have no
gaps, and where a row number went, or which row number a slot holds, takes a few
multiplications and no table (`place`, `row_at`).
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shipping import ship
from tidemark.llm.storage import written
from tidemark.llm.words import mix

#: Fixed value: ``monotonically_increasing_id`` keeps the row number within a partition in
#: its lower 33 bits.
_ROW_BITS = (1 << 33) - 1

ROUNDS = 6


def _sides(n: int) -> tuple[int, int]:
    a = int(np.ceil(np.sqrt(max(n, 1))))
    return a, -(-max(n, 1) // a)


def _round(right: np.ndarray, number: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(right + np.uint64((seed * 0x9E3779B97F4A7C15 + number * 0xBF58476D1CE4E5B9) % (1 << 64)))


def _forward(x: np.ndarray, a: int, b: int, seed: int) -> np.ndarray:
    left, right = x // np.uint64(b), x % np.uint64(b)
    for k in range(ROUNDS):
        if k % 2 == 0:
            left = (left + _round(right, k, seed) % np.uint64(a)) % np.uint64(a)
        else:
            right = (right + _round(left, k, seed) % np.uint64(b)) % np.uint64(b)
    return left * np.uint64(b) + right


def _backward(x: np.ndarray, a: int, b: int, seed: int) -> np.ndarray:
    left, right = x // np.uint64(b), x % np.uint64(b)
    for k in reversed(range(ROUNDS)):
        if k % 2 == 0:
            left = (left + np.uint64(a) - _round(right, k, seed) % np.uint64(a)) % np.uint64(a)
        else:
            right = (right + np.uint64(b) - _round(left, k, seed) % np.uint64(b)) % np.uint64(b)
    return left * np.uint64(b) + right


def _walk(rows: np.ndarray, n: int, seed: int, step) -> np.ndarray:
    """Apply ``step`` until every value is below ``n``; each walk ends, as it is a cycle."""
    a, b = _sides(n)
    out = step(np.asarray(rows, dtype=np.uint64), a, b, seed)
    while len(outside := np.flatnonzero(out >= np.uint64(n))):
        out[outside] = step(out[outside], a, b, seed)
    return out.astype(np.int64)


def place(rows: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The shuffled places of row numbers of a table with ``n`` rows."""
    return _walk(rows, n, seed, _forward)


def row_at(places: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The row numbers at shuffled places; the inverse of `place`."""
    return _walk(places, n, seed, _backward)


def shard_documents(
    docs: DataFrame, shards: int, seed: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    Only ids, sizes and checksums are sorted (by range, over all tasks) and written once; the
    row number is the place in a partition plus the sizes of the partitions before it.

    Null texts count as empty (size 8), null ids sort first. Rows with one id are ordered by
    checksum and size; rows that are equal in all of these are interchangeable. Other columns
    are not read. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    ordered = (
        rows.orderBy("doc_id", "text_crc32", "size")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    stored = written(ordered, "sharding")
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition of the sort: no more than shuffle partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    n = stored.count()

    def shuffled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(place(batch.to_numpy(), n, seed))

    number = F.col("_before") + F.col("_row")
    placed = stored.join(F.broadcast(starts), "_part").withColumn(
        "_place", F.pandas_udf(shuffled, "long")(number)
    )
    return placed.select(
        F.col("doc_id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("_place") % shards).cast("int").alias("shard"),
        F.expr(f"_place div {int(shards)}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
