"""A progress table on shared storage, kept as snapshots and batches of events.

    <path>/batch/<writer>/batch_id=<n>/      events as they came
    <path>/snapshot/version=<n>/             last event per key, ordered by key
    <path>/folded/version=<n>                names of the batches in that snapshot
    <path>/buckets/version=<n>               number of its buckets, where it has any

A reader takes the newest complete snapshot and the batches that are not in it yet
and keeps the last event of every key.  Events carry their order (``seq``), so it
makes no difference in which batch one is: a batch written twice, or read although
a snapshot has it, changes nothing.  Deletes stay in the snapshot as events, to
win over saves that come in late, and are left out on reading.

A batch or snapshot counts once Spark has put its ``_SUCCESS`` file there.

With ``buckets`` a snapshot is bucketed by key, by Spark's own bucketing: reading it beside
later batches scans it once and shuffles the batches only, and so does the next compaction.
Without, files hold ranges of keys, which suits lookups of prefixes and ranges better.
"""

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import operators as ops
from tidemark.functions import moment
from tidemark.plans import fits_broadcast, latest_rows, narrow_to_keys
from tidemark.schema import DELETE, KEY_COLS, PROGRESS_LOG, SAVE
from tidemark.sources.tables import ensure_table, write_sorted

Narrowing = Callable[[DataFrame], DataFrame]


def checked(events: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """The events as they are, rows without ``op`` as saves; one that lacks its key, its place in
    the order or a known kind fails the query.  Check before cutting events to the last ones:
    a cut drops what has no order without a word."""
    if "op" not in events.columns:
        events = events.withColumn("op", F.lit(SAVE))
    sound = F.lit(True)
    for name in [*key_cols, "seq", "op"]:
        message = F.raise_error(F.lit(f"an event without {name}")).cast("boolean")
        sound = F.when(F.col(name).isNull(), message).otherwise(sound)
    known = F.col("op").isin(SAVE, DELETE)
    message = F.concat(F.lit("an event of the unknown kind "), F.col("op"))
    sound = F.when(F.col("op").isNotNull() & ~known, F.raise_error(message).cast("boolean")).otherwise(sound)
    return events.where(sound)


class ProgressTable:
    """Saves, deletes and lookups in bulk.  One process writes at a time."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key_cols: Sequence[str] = KEY_COLS,
        schema: T.StructType = PROGRESS_LOG,
        buckets: int | None = None,
    ):
        """``buckets`` is for the snapshots still to be written; each is read by its own number."""
        self.spark = spark
        self.buckets = buckets
        self.path = path.rstrip("/")
        self.key_cols = list(key_cols)
        self.schema = schema

    # -- reading ---------------------------------------------------------

    def events(self) -> DataFrame:
        """The last event of every key, deletes included."""
        return self._last_events()

    def read(self) -> DataFrame:
        """The current row of every key."""
        return self._current()

    def load(self, keys: DataFrame) -> DataFrame:
        """The current row of every key asked for; nulls for keys without one."""
        found = self._current(lambda rows: narrow_to_keys(rows, keys, self.key_cols))
        asked = keys.select(*self.key_cols)
        return asked.join(found, self.key_cols, "left").select(*found.columns)

    def load_key(self, **key) -> DataFrame:
        """The current row of one key, if any; the key filter reaches the files."""
        return self._current(lambda rows: ops.by_key(rows, **key))

    def exists(self, keys: DataFrame) -> DataFrame:
        """The keys that have a row.  Of the stored columns only key, order and kind are read."""
        needed = [*self.key_cols, "op", "seq"]
        found = self._current(
            lambda rows: narrow_to_keys(rows.select(*needed), keys, self.key_cols)
        )
        return keys.join(found.select(*self.key_cols), self.key_cols, "left_semi")

    def list_group(self, column: str, value) -> DataFrame:
        """The current rows of one pipeline, or of one value of another column."""
        if column in self.key_cols:
            return self._current(lambda rows: ops.by_group(rows, column, value))
        return ops.by_group(self.read(), column, value)

    def resume(self, source: DataFrame, offset_col: str) -> DataFrame:
        """The records of ``source`` after the offsets in this table; see ``ops.resume``."""
        needed = [*self.key_cols, "offset_json", "offset_num", "op", "seq"]
        offsets = self._current(lambda rows: rows.select(*needed))
        return ops.resume(source, offsets, offset_col, self.key_cols)

    # -- writing ---------------------------------------------------------

    def save(
        self, rows: DataFrame, batch_id: int | str | None = None, writer: str = "batch"
    ) -> None:
        """Add saves.  Rows without ``op`` are saves; rows with it are taken as they are."""
        if "op" not in rows.columns:
            rows = rows.withColumn("op", F.lit(SAVE))
        self.append(rows, batch_id, writer)

    def delete(
        self, keys: DataFrame, as_of, batch_id: int | str | None = None, writer: str = "batch"
    ) -> None:
        """Delete keys.  ``keys`` needs ``seq``, the place of the deletes in the order."""
        events = keys.select(
            *self.key_cols,
            "seq",
            F.lit(DELETE).alias("op"),
            F.lit("null").alias("offset_json"),
            moment(as_of).alias("updated_at"),
        )
        self.append(events, batch_id, writer)

    def append(
        self, events: DataFrame, batch_id: int | str | None = None, writer: str = "batch"
    ) -> None:
        """Write one batch of events.

        Give a ``batch_id`` only where a batch may have to be written again: the same
        number means the same events, so one that is complete is left as it is.  Columns
        that are left out are null, except for the text of an offset given as a number.

        Nothing is lost in silence: columns the table does not have are refused, and an
        event without key, place in the order or a known kind fails the write.
        """
        unknown = [c for c in events.columns if c not in self.schema.names]
        if unknown:
            raise ValueError(f"the table has no columns {unknown}")
        lacking = [c for c in [*self.key_cols, "op", "seq"] if c not in events.columns]
        if lacking:
            raise ValueError(f"events lack the columns {lacking}")
        if "offset_json" not in events.columns and "offset_num" in events.columns:
            events = events.withColumn("offset_json", F.col("offset_num").cast("string"))
        columns = [
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in events.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in self.schema
        ]
        name = uuid.uuid4().hex if batch_id is None else batch_id
        target = f"{self.path}/batch/{writer}/batch_id={name}"
        if batch_id is not None and self._complete(target):
            return
        checked(events.select(*columns), self.key_cols).write.mode("overwrite").parquet(target)
        self._mark_complete(target)

    def update_offset(
        self, changes: DataFrame, as_of, batch_id: int | str | None = None, writer: str = "batch"
    ) -> None:
        """Change the offsets of keys that have a row.

        ``changes`` has the key, the offset and ``seq``; keys without a row are ignored.
        """
        last = latest_rows(changes, self.key_cols, ["seq"])
        known = self._current(lambda rows: narrow_to_keys(rows, last, self.key_cols))
        old = known.drop("seq").join(last.select(*self.key_cols, "seq"), self.key_cols)
        self.save(ops.update_offset(old, last, as_of, self.key_cols), batch_id, writer)

    def clear(
        self,
        as_of,
        seq: int,
        pipeline_id: str | None = None,
        batch_id: int | str | None = None,
        writer: str = "batch",
    ) -> None:
        """Delete every key, or those of one pipeline, at place ``seq`` of the order."""
        rows = self.read() if pipeline_id is None else self.list_group("pipeline_id", pipeline_id)
        keys = rows.select(*self.key_cols).withColumn("seq", F.lit(seq))
        self.delete(keys, as_of, batch_id, writer)

    def compact(self, drop_deletes_before=None) -> None:
        """Write a new snapshot from all there is; later readers need fewer files.

        Deletes older than ``drop_deletes_before`` are forgotten: give a time before
        which no event can still come in.
        """
        newest = self._newest_snapshot()
        version = 0 if newest is None else newest + 1
        folded = [p.removeprefix(f"{self.path}/batch/") for p in self._all_batches()]
        rows = self.events()
        if drop_deletes_before is not None:
            old = (F.col("op") == DELETE) & (F.col("updated_at") < moment(drop_deletes_before))
            rows = rows.where(~old)
        # The list is there before the snapshot counts as complete.
        self._write_text(f"{self.path}/folded/version={version}", "\n".join(folded))
        target = f"{self.path}/snapshot/version={version}"
        self._delete(f"{self.path}/buckets/version={version}")
        if self.buckets is None:
            write_sorted(rows, target, self.key_cols, "overwrite")
        else:
            # What batches were merged into, in buckets of this number, lies in them already.
            same = newest is not None and self._buckets(newest) == self.buckets
            merged = same and bool(self.batches())
            if not merged:
                rows = rows.repartition(self.buckets, *self.key_cols)
            self._write_text(f"{self.path}/buckets/version={version}", str(self.buckets))
            name = self._bucketed(version, self.buckets)
            rows.select(*self.schema.names).write.insertInto(name, overwrite=True)
        self._mark_complete(target)

    def vacuum(self) -> None:
        """Remove what the newest snapshot has replaced.

        Call it when no reader that started before the last :meth:`compact` is left.
        """
        newest = self._newest_snapshot()
        if newest is None:
            return
        for batch in self._folded(newest):
            self._delete(f"{self.path}/batch/{batch}")
        for name in self._children(f"{self.path}/snapshot"):
            version = int(name.split("=")[1])
            if version < newest:
                buckets = self._buckets(version)
                if buckets:
                    # Its files go with the folder.
                    self.spark.sql(f"DROP TABLE IF EXISTS {self._bucketed(version, buckets)}")
                self._delete(f"{self.path}/snapshot/{name}")

    def batches(self) -> list[str]:
        """Paths of the complete batches that are not in the newest snapshot."""
        newest = self._newest_snapshot()
        folded = set() if newest is None else set(self._folded(newest))
        root = f"{self.path}/batch/"
        return [p for p in self._all_batches() if p.removeprefix(root) not in folded]

    # -- storage ---------------------------------------------------------

    def _current(self, narrow: Narrowing = lambda rows: rows) -> DataFrame:
        # A flag instead of the text, so that narrow rows are aggregated by hash.
        def flagged(rows: DataFrame) -> DataFrame:
            return narrow(rows).withColumn("op", F.col("op") == DELETE)

        return self._last_events(flagged).where(~F.col("op")).drop("op")

    def _last_events(self, narrow: Narrowing = lambda rows: rows) -> DataFrame:
        """The last event of every key.  ``narrow`` keeps all or no events of a key.

        The snapshot has one event per key already.  One in buckets is read once and meets
        the batches where it lies.  Otherwise, beside small batches only its rows of the keys
        in them are compared; the others are read and passed on.
        """
        version, paths = self._newest_snapshot(), self.batches()
        if version is None and not paths:
            return narrow(self.spark.createDataFrame([], self.schema))
        reader = self.spark.read.schema(self.schema)
        if version is None:
            return latest_rows(narrow(reader.parquet(*paths)), self.key_cols, ["seq"])
        buckets = self._buckets(version)
        if buckets:
            stored = self.spark.table(self._bucketed(version, buckets))
        else:
            stored = reader.parquet(f"{self.path}/snapshot/version={version}")
        snapshot = narrow(stored)
        if not paths:
            return snapshot
        recent = latest_rows(narrow(reader.parquet(*paths)), self.key_cols, ["seq"])
        if buckets:
            return self._later(snapshot, recent.repartition(buckets, *self.key_cols))
        if not fits_broadcast(recent):
            return latest_rows(snapshot.unionByName(recent), self.key_cols, ["seq"])
        touched = recent.select(*self.key_cols)
        compared = snapshot.join(touched, self.key_cols, "left_semi").unionByName(recent)
        untouched = snapshot.join(touched, self.key_cols, "left_anti")
        return untouched.unionByName(latest_rows(compared, self.key_cols, ["seq"]))

    def _later(self, snapshot: DataFrame, recent: DataFrame) -> DataFrame:
        """Of both, one row per key, the later one.  Each has one at most."""
        names = {c: f"_recent_{c}" for c in recent.columns}
        renamed = recent.withColumnsRenamed(names)
        same = [snapshot[c] == renamed[names[c]] for c in self.key_cols]
        changed = F.col(names["seq"]).isNotNull() & (
            F.col("seq").isNull() | (F.col(names["seq"]) >= F.col("seq"))
        )
        return snapshot.join(renamed, same, "full").select(
            *[F.when(changed, F.col(names[c])).otherwise(F.col(c)).alias(c) for c in snapshot.columns]
        )

    def _bucketed(self, version: int, buckets: int) -> str:
        """The name in the catalog of a snapshot in buckets, which is the only way to Spark's
        bucketing.  The catalog need not outlive the session: the table's files are where all
        snapshots are."""
        location = self._hadoop_path(f"{self.path}/snapshot/version={version}")
        qualified = self._file_system(location).makeQualified(location).toString()
        digest = hashlib.sha256(qualified.encode()).hexdigest()[:32]
        name = f"progress_{digest}_{buckets}"
        ensure_table(self.spark, name, self.key_cols, self.schema, buckets, qualified)
        return name

    def _buckets(self, version: int) -> int | None:
        location = self._hadoop_path(f"{self.path}/buckets/version={version}")
        if not self._file_system(location).exists(location):
            return None
        return int(self._read_text(location))

    def _all_batches(self) -> list[str]:
        root = f"{self.path}/batch"
        return [
            f"{root}/{writer}/{batch}"
            for writer in self._children(root)
            for batch in self._children(f"{root}/{writer}")
            if self._complete(f"{root}/{writer}/{batch}")
        ]

    def _newest_snapshot(self) -> int | None:
        root = f"{self.path}/snapshot"
        versions = [
            int(name.split("=")[1])
            for name in self._children(root)
            if self._complete(f"{root}/{name}")
        ]
        return max(versions, default=None)

    def _hadoop_path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _file_system(self, location):
        return location.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _children(self, path: str) -> list[str]:
        location = self._hadoop_path(path)
        fs = self._file_system(location)
        if not fs.exists(location):
            return []
        return [s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory()]

    def _complete(self, path: str) -> bool:
        marker = self._hadoop_path(f"{path}/_SUCCESS")
        return self._file_system(marker).exists(marker)

    def _mark_complete(self, path: str) -> None:
        """Put the marker there where Spark is told not to."""
        if not self._complete(path):
            self._write_text(f"{path}/_SUCCESS", "")

    def _folded(self, version: int) -> list[str]:
        text = self._read_text(self._hadoop_path(f"{self.path}/folded/version={version}"))
        return text.split("\n") if text else []

    def _read_text(self, location) -> str:
        stream = self._file_system(location).open(location)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_text(self, path: str, text: str) -> None:
        location = self._hadoop_path(path)
        stream = self._file_system(location).create(location, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def _delete(self, path: str) -> None:
        location = self._hadoop_path(path)
        self._file_system(location).delete(location, True)
