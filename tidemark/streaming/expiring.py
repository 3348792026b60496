"""Keyed state that is gone a while after the last save."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions import moment
from tidemark.operators.expiry import live, stamp_expiry
from tidemark.plans import latest_rows
from tidemark.schema import DELETE, KEY_COLS, PROGRESS_LOG
from tidemark.streaming.sinks import _writer_name, stream_to
from tidemark.table import ProgressTable, checked

#: The end of what has none.
_NEVER = "9999-12-31 00:00:00"


def ttl_state(
    stream: DataFrame,
    table: ProgressTable,
    ttl_seconds: int,
    checkpoint: str,
    saved_at: str = "updated_at",
    aside: Callable[[DataFrame, int], None] | None = None,
    compact_every: int | None = None,
) -> DataStreamWriter:
    """Keep the last event of every key in ``table``, with the end of its life.

    A save lives ``ttl_seconds`` from ``saved_at`` on; a delete ends its key at once.  The
    last event of a key is the one with the highest ``seq``, however late it comes.
    Read the state with :func:`live_state`.  Events without a time have no end: they are
    handed to ``aside``, with the batch's number, and without it they fail the batch, as does
    any event that ``ProgressTable.append`` would refuse.

    Each micro-batch is an aggregate in the JVM and is written beside the earlier ones.  The
    table keeps what is over; :func:`wheel_state` drops it.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        timed = checked(_timed(batch, batch_id, saved_at, aside), table.key_cols)
        last = latest_rows(stamp_expiry(timed, ttl_seconds, saved_at=saved_at), table.key_cols, ["seq"])
        table.save(last, batch_id, _writer_name(batch))
        if compact_every and (batch_id + 1) % compact_every == 0:
            table.compact()

    return stream_to(stream, apply, checkpoint)


def live_state(table: ProgressTable, as_of) -> DataFrame:
    """The keys that are neither deleted nor over at ``as_of``."""
    return live(table.read(), as_of)


def _timed(
    batch: DataFrame, batch_id: int, saved_at: str, aside: Callable[[DataFrame, int], None] | None
) -> DataFrame:
    """The events with a time; the others go to ``aside`` or fail the batch."""
    if aside is not None:
        aside(batch.where(F.col(saved_at).isNull()), batch_id)
        return batch.where(F.col(saved_at).isNotNull())
    lacks = F.raise_error(F.lit(f"an event without {saved_at}")).cast("boolean")
    return batch.where(F.when(F.col(saved_at).isNull(), lacks).otherwise(F.lit(True)))


class ExpiryWheel:
    """State on shared storage whose folders are the times at which it ends.

        <path>/part=<batch>/until=<n>/     one row per key of the batch
        <path>/whole=<batch>/until=<n>/    one row per key of all there was up to that batch

    A row is the last event of its key (deletes included) and the end of the latest-ending event
    of the key, whichever that is.  Its folder is that end, in steps of ``step_seconds``.  A batch
    first looks up the rows its keys have and takes their ends over, so a key's newer row never
    lies in an earlier folder than its older ones.  Once a folder's time has come, every event of
    every key in it is over, or a newer row is elsewhere: the folder goes as a whole, unread, and
    no older event can show again.

    One process writes at a time.  A batch is known by its number: one that comes again and is
    complete is left as it is.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key_cols: Sequence[str] = KEY_COLS,
        schema: T.StructType = PROGRESS_LOG,
        step_seconds: int = 3600,
    ):
        if step_seconds < 1:
            raise ValueError("step_seconds must be at least 1")
        self.spark, self.path, self.step_seconds = spark, path.rstrip("/"), step_seconds
        self.key_cols = list(key_cols)
        self.schema = T.StructType([f for f in schema if f.name != "ends_at"]).add("ends_at", T.TimestampType())

    def events(self) -> DataFrame:
        """The last event of every key that is still held, deletes included."""
        return self._held().drop("ends_at")

    def live(self, as_of) -> DataFrame:
        """The keys that are neither deleted nor over at ``as_of``, which is no earlier than the
        latest time given to :meth:`drop_ended`."""
        return live(self.events().where(F.col("op") != DELETE).drop("op"), as_of)

    def add(self, events: DataFrame, batch_id: int, whole: bool = False, as_of=None) -> None:
        """Take a batch of events with ``seq``, ``op`` and ``expires_at`` (null: no end).

        With ``whole`` the rows of all keys are written anew, one for each, and replace the
        folders before; otherwise the batch costs a lookup of its keys and the rows it changes.
        With ``as_of`` the batch's folders whose time has come by then are not written; it is for
        a caller that goes on with :meth:`drop_ended` of that time, which would remove them.
        """
        target = f"{self.path}/{'whole' if whole else 'part'}={batch_id}"
        if not self._exists(f"{target}/_SUCCESS"):
            self._write(events, batch_id, whole, target, as_of)
        if whole:
            for name in self._names():
                if int(name.split("=")[1]) < batch_id:
                    self._delete(f"{self.path}/{name}")

    def _write(self, events: DataFrame, batch_id: int, whole: bool, target: str, as_of=None) -> None:
        typed = [
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in events.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in self.schema if f.name != "ends_at"
        ]
        ends = F.coalesce("expires_at", F.lit(_NEVER).cast("timestamp")).alias("ends_at")
        new = self._merged(events.select(*typed, ends))
        old = self._held(before=batch_id)
        if not whole:
            # The join is on the rows held alone: on the new ones it would drop a key that is
            # null before the check of the events sees it.
            old = old.join(new.select(*self.key_cols), self.key_cols, "left_semi")
        rows = self._merged(old.unionByName(new))
        step = F.floor(F.unix_seconds("ends_at") / self.step_seconds)
        rows = rows.withColumn("until", step)
        if as_of is not None:
            rows = rows.where((F.col("until") + 1) * self.step_seconds > self._seconds(as_of))
        # A small folder is one file, a large one is split by its real size: without this every
        # task of the aggregate would put a file into every folder.
        rows = rows.hint("rebalance", "until")
        rows.write.mode("overwrite").partitionBy("until").parquet(target)
        if not self._exists(f"{target}/_SUCCESS"):
            # Where Spark is told not to put the marker there.
            fs, location = self._storage(f"{target}/_SUCCESS")
            fs.create(location).close()

    def drop_ended(self, as_of) -> int:
        """Remove the folders whose time has come at ``as_of``; their number. Nothing is read."""
        now, gone = self._seconds(as_of), 0
        for name in self._names():
            for folder in self._children(f"{self.path}/{name}"):
                until = folder.removeprefix("until=")
                if folder != until and (int(until) + 1) * self.step_seconds <= now:
                    self._delete(f"{self.path}/{name}/{folder}")
                    gone += 1
        return gone

    def _seconds(self, as_of) -> int:
        return self.spark.range(1).select(F.unix_seconds(moment(as_of).cast("timestamp"))).first()[0]

    def _merged(self, rows: DataFrame) -> DataFrame:
        """One row per key: its last event, and the end of the one that ends last."""
        others = [c for c in rows.columns if c not in (*self.key_cols, "ends_at")]
        last = F.max_by(F.struct(*others), "seq").alias("_last")
        found = rows.groupBy(*self.key_cols).agg(last, F.max("ends_at").alias("ends_at"))
        return found.select(*[F.col(f"_last.{c}").alias(c) if c in others else F.col(c) for c in rows.columns])

    def _held(self, before: int | None = None) -> DataFrame:
        names = {int(n.split("=")[1]): n for n in self._names() if before is None or int(n.split("=")[1]) < before}
        first = max((k for k, n in names.items() if n.startswith("whole=")), default=-1)
        # A row of a later batch has taken over what the key's earlier rows said.
        parts = []
        for k, name in names.items():
            if k >= first and self._children(f"{self.path}/{name}"):
                rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/{name}")
                parts.append(rows.select(*self.schema.names, F.lit(k).alias("_batch")))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        if len(parts) == 1:
            return rows.drop("_batch")
        return latest_rows(rows, self.key_cols, ["_batch"]).drop("_batch")

    def _names(self) -> list[str]:
        """The complete batches."""
        return [n for n in self._children(self.path) if self._exists(f"{self.path}/{n}/_SUCCESS")]

    def _storage(self, path: str):
        location = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return location.getFileSystem(self.spark._jsc.hadoopConfiguration()), location

    def _exists(self, path: str) -> bool:
        fs, location = self._storage(path)
        return fs.exists(location)

    def _children(self, path: str) -> list[str]:
        fs, location = self._storage(path)
        if not fs.exists(location):
            return []
        return [s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory()]

    def _delete(self, path: str) -> None:
        fs, location = self._storage(path)
        fs.delete(location, True)


def wheel_state(
    stream: DataFrame,
    wheel: ExpiryWheel,
    ttl_seconds: int | str | Column,
    checkpoint: str,
    saved_at: str = "updated_at",
    aside: Callable[[DataFrame, int], None] | None = None,
    fold_every: int | None = None,
) -> DataStreamWriter:
    """As :func:`ttl_state`, in an :class:`ExpiryWheel`: what is over leaves the storage.

    The stream's own time, the latest ``saved_at`` of each batch, moves the wheel.  An event
    that comes in when its key's last one has gone is taken as the key's first.  ``fold_every``
    batches the folders become one row per key again.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        timed = checked(_timed(batch, batch_id, saved_at, aside), wheel.key_cols)
        latest = batch.agg(F.unix_seconds(F.max(saved_at))).first()[0]
        now = None if latest is None else F.timestamp_seconds(F.lit(latest))
        wheel.add(
            stamp_expiry(timed, ttl_seconds, saved_at=saved_at), batch_id,
            whole=bool(fold_every) and (batch_id + 1) % fold_every == 0,
            as_of=now,
        )
        if now is not None:
            wheel.drop_ended(now)

    return stream_to(stream, apply, checkpoint)
