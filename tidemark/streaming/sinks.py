"""Streams into tables and logs, and streams that start where reading stopped."""

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators.lookups import resume
from tidemark.plans import latest_rows
from tidemark.schema import KEY_COLS
from tidemark.table import ProgressTable, checked


def stream_to(
    stream: DataFrame, writer: Callable[[DataFrame, int], None], checkpoint: str
) -> DataStreamWriter:
    """Hand every micro-batch to the user's own writer, with its number.

    After a failure the last batch may come again with the same number; a writer
    that replaces by number is exact.
    """
    return stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)


def stream_append(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> DataStreamWriter:
    """Add a stream of events to a log, each exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("checkpointLocation", checkpoint)


def stream_upsert(
    stream: DataFrame, table: ProgressTable, checkpoint: str, compact_every: int | None = None
) -> DataStreamWriter:
    """Apply a stream of saves and deletes (or, without ``op``, of saves) to a table.

    A micro-batch is cut to the last event per key and written beside the earlier
    ones: the cost is that of the batch, not of the table.  Its place is named after
    the query and the batch number, so a batch that runs again replaces itself.
    An event that ``ProgressTable.append`` would refuse fails its batch.  ``compact_every`` folds the batches into a snapshot now and then.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        last = latest_rows(checked(batch, table.key_cols), table.key_cols, ["seq"])
        table.save(last, batch_id, _writer_name(batch))
        if compact_every and (batch_id + 1) % compact_every == 0:
            table.compact()

    return stream_to(stream, apply, checkpoint)


def track(
    stream: DataFrame,
    table: ProgressTable,
    offset_col: str,
    time_col: str,
    checkpoint: str,
    process: Callable[[DataFrame, int], None] | None = None,
) -> DataStreamWriter:
    """Process a source stream and keep the furthest offset of every key in a table.

    ``process`` gets each micro-batch first; offsets move only after it returned.
    The offset is the order of the table's events, so an older batch that comes
    again cannot move one back.
    """

    def move_offsets(batch: DataFrame, batch_id: int) -> None:
        furthest = batch.groupBy(*table.key_cols).agg(
            F.max(offset_col).alias("offset_num"), F.max(time_col).alias("updated_at")
        )
        table.save(
            furthest.withColumn("seq", F.col("offset_num")), batch_id, _writer_name(batch)
        )

    def apply(batch: DataFrame, batch_id: int) -> None:
        if process is None:
            move_offsets(batch, batch_id)
            return
        # Read once for both uses; a part that is lost is read again from the source.
        batch.persist()
        try:
            process(batch, batch_id)
            move_offsets(batch, batch_id)
        finally:
            batch.unpersist()

    return stream_to(stream, apply, checkpoint)


def resume_stream(
    stream: DataFrame, table: DataFrame, offset_col: str, key_cols: Sequence[str] = KEY_COLS
) -> DataFrame:
    """The records of a stream that come after their key's offset in ``table``.

    A stream-static join.  Restarts of the query itself are covered by its own
    checkpoint; this is for a new query that goes on where an earlier reader stopped.
    Offsets without an order are refused, as by ``resume``.  Where a stream is hot and the
    table is large, use :func:`resume_to`.
    """
    return resume(stream, table, offset_col, key_cols)


def resume_to(
    stream: DataFrame,
    table: DataFrame,
    offset_col: str,
    writer: Callable[[DataFrame, int], None],
    checkpoint: str,
    key_cols: Sequence[str] = KEY_COLS,
) -> DataStreamWriter:
    """Hand the records that come after their key's offset in ``table`` to ``writer``, batch by batch.

    The rows are those of :func:`resume_stream`.  Each micro-batch is joined as a batch of its own,
    planned adaptively: the records of a hot stream are split over several tasks, also beside a
    table that is too large to broadcast.  ``writer`` gets the batch's number and must write
    before it returns; one that replaces by number is exact.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        # The session is the stream's own copy, in which Spark may have switched this off.
        with _adaptive(batch.sparkSession):
            writer(resume(batch, table, offset_col, key_cols), batch_id)

    return stream_to(stream, apply, checkpoint)


def latest_stream(
    stream: DataFrame, key_cols: Sequence[str] = KEY_COLS, seq: str = "seq"
) -> DataFrame:
    """The last event of every key so far, as a streaming aggregate.

    Write it in ``update`` mode for changed keys or ``complete`` mode for all.  The
    state has one row per key; rows are reduced in each task before the shuffle.
    """
    return latest_rows(stream, key_cols, [seq])


@contextmanager
def _adaptive(spark: SparkSession) -> Iterator[None]:
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _writer_name(batch: DataFrame) -> str:
    # The identity of the query is kept in its checkpoint and survives restarts.
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("the stream has no query id to name its batches by")
    return f"query-{query}"
