"""Rows removed from a log on storage, file by file."""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import moment
from tidemark.operators.changes import delete_history
from tidemark.plans import join_on_keys
from tidemark.schema import KEY_COLS, PROGRESS_LOG

#: Folders of rewrites within a log; Spark's readers skip names with an underscore.
_PREFIX = "_rewrite-"


def delete_history_files(
    spark: SparkSession,
    path: str,
    keys: DataFrame,
    key_cols: Sequence[str] = KEY_COLS,
    start=None,
    stop=None,
    ts: str = "updated_at",
    partition_by: Sequence[str] = (),
    schema: T.StructType = PROGRESS_LOG,
) -> int:
    """:func:`~tidemark.operators.delete_history` on a Parquet log at ``path``, by copy on write.

    Only files that hold a row to be deleted are rewritten; all others keep their names and
    contents.  They are found by a scan of the key and time columns.  ``partition_by`` names
    the columns that the log is partitioned by.  Returns the number of files replaced.

    The rows that stay are written beside the log, with the names of the files that they
    replace; then they are moved into it and those files removed.  In between, a reader may see
    kept rows twice, but never a part of them: what cuts a log to its last events gives the same.
    A rewrite that was broken off is finished by the next call or by :func:`finish_rewrites`.
    One process at a time rewrites a log, and nobody appends rows of ``keys`` meanwhile.
    """
    finish_rewrites(spark, path)
    log = spark.read.schema(schema).parquet(path)
    period = F.lit(True)
    if start is not None:
        period = period & (F.col(ts) >= moment(start))
    if stop is not None:
        period = period & (F.col(ts) <= moment(stop))
    asked = log.where(period).select(*key_cols, F.col("_metadata.file_path").alias("_file"))
    # Names of files only, of which the driver holds a list for every scan.
    hit = join_on_keys(asked, keys.select(*key_cols), key_cols, "left_semi").select("_file").distinct()
    files = [row._file for row in hit.collect()]
    if not files:
        return 0
    # A condition on file names keeps Spark from opening the others.
    touched = log.where(F.col("_metadata.file_path").isin(files))
    place = f"{path.rstrip('/')}/{_PREFIX}{uuid.uuid4().hex}"
    kept = delete_history(touched, keys, key_cols, start, stop, ts)
    kept.write.partitionBy(*partition_by).parquet(f"{place}/rows")
    # From here on the rewrite counts.
    spark.createDataFrame([(f,) for f in files], "file string").write.text(f"{place}/replaced")
    _finish(spark, path, place)
    return len(files)


def finish_rewrites(spark: SparkSession, path: str) -> int:
    """Finish the rewrites of a log that were broken off; those not yet complete are dropped.

    Returns how many were finished.
    """
    fs, root = _storage(spark, path)
    finished = 0
    for status in fs.listStatus(root) if fs.exists(root) else ():
        name = status.getPath().getName()
        if not name.startswith(_PREFIX):
            continue
        place = f"{path.rstrip('/')}/{name}"
        if fs.exists(_path(spark, f"{place}/replaced/_SUCCESS")):
            _finish(spark, path, place)
            finished += 1
        else:
            fs.delete(_path(spark, place), True)
    return finished


def _finish(spark: SparkSession, path: str, place: str) -> None:
    """Every step may be done already; done again it changes nothing."""
    fs, root = _storage(spark, path)
    rows = fs.makeQualified(_path(spark, f"{place}/rows"))
    if fs.exists(rows):
        names = fs.listFiles(rows, True)
        while names.hasNext():
            file = names.next().getPath()
            if file.getName().startswith(("_", ".")):
                continue
            # The same folder of the log, below its partitions.
            below = file.toString()[len(rows.toString()) + 1 :]
            target = _path(spark, f"{fs.makeQualified(root).toString()}/{below}")
            fs.mkdirs(target.getParent())
            if not fs.rename(file, target):
                raise OSError(f"cannot move {file.toString()} to {target.toString()}")
    for row in spark.read.text(f"{place}/replaced").collect():
        # File names come from Spark as they stand in a URI.
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row.value)), False)
    fs.delete(_path(spark, place), True)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _storage(spark: SparkSession, path: str):
    location = _path(spark, path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location
