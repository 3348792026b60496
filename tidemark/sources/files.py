"""JSON payload files in a tree with one folder per pipeline."""

import re
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.codec import decode_payloads, encode_payloads
from tidemark.schema import KEY_COLS
from tidemark.sources.objects import list_new_objects, read_tree, stream_lists, tree_root

_PARTITIONED = T.StructType(
    [T.StructField("data", T.StringType()), T.StructField("pipeline_id", T.StringType())]
)

#: Whole files as bytes: Spark's reader of whole texts sets up codecs anew for each.
_OBJECTS = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"

#: Key columns that the tree and the payload hold anyway.
_HELD = ("pipeline_id", "stream_id")


def write_checkpoint_files(
    df: DataFrame,
    path: str,
    expiry: str | None = "expires_at",
    key_cols: Sequence[str] | None = None,
) -> None:
    """Write a table as JSON lines, one folder ``pipeline_id=…`` per pipeline.

    The payload holds all ``key_cols`` (by default the usual two, and ``partition`` where
    the table has it) and the column ``expiry``, if there is one.

    Pipelines in ``df`` are replaced, others stay.  Rows are gathered by pipeline so
    that a small one is one file; Spark splits a large one over several tasks and
    files by its real size instead of sending it to one writer.
    """
    if key_cols is None:
        key_cols = [*KEY_COLS, *[c for c in ("partition",) if c in df.columns]]
    extra = [c for c in key_cols if c not in _HELD]
    (
        encode_payloads(df, "data", extra, expiry if expiry in df.columns else None)
        .select("data", "pipeline_id")
        .hint("rebalance", "pipeline_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("pipeline_id")
        .text(path)
    )


def read_checkpoint_files(
    spark: SparkSession,
    path: str,
    pipeline_id: str | None = None,
    layout: str = "partitioned",
    mode: str = "permissive",
    suffix: str = ".json",
    key_cols: Sequence[str] = KEY_COLS,
) -> tuple[DataFrame, DataFrame]:
    """Rows of a tree of payload files, all of it or one pipeline: ``(good, bad)``.

    ``partitioned`` reads what :func:`write_checkpoint_files` wrote; only the folder
    of the pipeline asked for is scanned.  ``objects`` reads a tree with one JSON
    object per file, ``path/<pipeline>/<key><suffix>``; the pipeline is the name of
    the folder and the key becomes the column ``checkpoint_id``.  ``key_cols`` beyond the
    usual two are taken out of the payload.

    Tasks list the objects, once and at the call, and read them; the driver holds no list of
    them.  Patterns and storage that pyarrow does not know are looked up by Spark's own reader,
    whose driver holds the names of all.
    """
    extra = [c for c in key_cols if c not in _HELD and c != "checkpoint_id"]
    if layout == "partitioned":
        lines = spark.read.schema(_PARTITIONED).text(path)
        if pipeline_id is not None:
            lines = lines.where(F.col("pipeline_id") == pipeline_id)
        return decode_payloads(lines, "data", mode, extra)
    if layout != "objects":
        raise ValueError(f"unknown layout {layout!r}; one of ('partitioned', 'objects')")

    # Asking for one pipeline lists its folder only.
    tree = tree_root(spark, path, suffix, pipeline_id)
    if tree is not None:
        return decode_payloads(_as_text(read_tree(spark, tree, suffix)), "data", mode, extra)
    root = path.rstrip("/")
    if pipeline_id is not None:
        # A name, not a pattern.
        root += "/" + re.sub(r"([*?\[\]{}\\])", r"\\\1", pipeline_id)
    objects = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .schema(_OBJECTS).format("binaryFile").load(root)
    )
    return decode_payloads(_named(objects, suffix), "data", mode, extra)


def stream_checkpoint_files(
    spark: SparkSession,
    path: str,
    mode: str = "permissive",
    suffix: str = ".json",
    key_cols: Sequence[str] = KEY_COLS,
    files_per_batch: int = 10_000,
    lists: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """New objects of a tree with one JSON object per file, as streams: ``(good, bad)``.

    The rows are those of :func:`read_checkpoint_files` for the layout ``objects``.  A name is read
    once: an object that is written anew under its old name does not come again, so writers that
    change objects must give them new names.  ``files_per_batch`` bounds a micro-batch; what is
    left comes with the next.  Start the stream within :func:`many_files`.

    Spark's own source, which is used by default, looks the tree up at every trigger and holds the
    names of all objects, also of those read, in the driver.  For trees of millions of objects name
    a folder ``lists``, as lasting as the stream's checkpoint: tasks list the tree, at this call and
    whenever :func:`list_new_objects` is called, and the stream reads the lists, one per
    micro-batch.  Objects that come later wait for the next such call.
    """
    extra = [c for c in key_cols if c not in _HELD and c != "checkpoint_id"]
    if lists is not None:
        list_new_objects(spark, path, lists, suffix, files_per_batch)
        objects = stream_lists(spark, tree_root(spark, path, suffix), suffix, lists)
        return decode_payloads(_as_text(objects), "data", mode, extra)
    objects = (
        spark.readStream.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .option("maxFilesPerTrigger", files_per_batch)
        # What is listed is kept for the next batches instead of being looked through for each.
        .option("maxCachedFiles", 100 * files_per_batch)
        .schema(_OBJECTS).format("binaryFile").load(path.rstrip("/"))
    )
    return decode_payloads(_named(objects, suffix), "data", mode, extra)


@contextmanager
def many_files(spark: SparkSession) -> Iterator[None]:
    """Settings for reading many small files; a stream that starts within keeps them.

    Spark looks up every file of a micro-batch in a task of its own (up to 10,000) and counts 4 MB
    for opening one, which makes a task of 32.  Here the look-ups are dealt over a few tasks for
    each core, and a task reads some 120 files.
    """
    settings = {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism),
        "spark.sql.files.openCostInBytes": str(1 << 20),
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def write_checkpoint_objects(
    df: DataFrame,
    path: str,
    key_col: str = "checkpoint_id",
    suffix: str = ".json",
    expiry: str | None = "expires_at",
    key_cols: Sequence[str] = KEY_COLS,
) -> None:
    """Write every row as a JSON object of its own, ``path/<pipeline_id>/<key_col><suffix>``.

    For trees that other tools read; a table of many rows belongs in files of many rows.  An object
    costs far more than its bytes, so the rows are dealt out by number over the session's shuffle
    partitions, at least one for each core; every task writes the objects of its rows.  A task that runs again writes the
    same objects again; other objects stay.  A name that is null or empty, holds a slash, or
    begins with a dot or an underscore, which readers would skip, fails the write.
    """
    extra = [c for c in key_cols if c not in (*_HELD, key_col)]
    expiry = expiry if expiry in df.columns else None
    objects = encode_payloads(df, "data", extra, expiry).select(
        _object_name("pipeline_id").alias("folder"), _object_name(key_col).alias("name"), "data"
    )
    root = path.rstrip("/")
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    objects.repartition(tasks).foreachPartition(lambda rows: _put(rows, root, suffix))


def _put(rows: Iterable[Row], root: str, suffix: str) -> None:
    # Local paths are named without a scheme or as Hadoop writes them, with file:/.
    uri = re.sub(r"^file:/+", "/", root)
    files, base = FileSystem.from_uri(uri)
    made = set()
    for row in rows:
        if row.folder not in made:
            files.create_dir(f"{base}/{row.folder}", recursive=True)
            made.add(row.folder)
        with files.open_output_stream(f"{base}/{row.folder}/{row.name}{suffix}") as out:
            out.write(row.data.encode())


def _object_name(column: str) -> Column:
    name = F.col(column).cast("string")
    refusal = F.raise_error(F.concat(F.lit(f"no object can have the {column} "), F.coalesce(name, F.lit("null"))))
    return F.when(name.rlike("^[^/._][^/]*$"), name).otherwise(refusal.cast("string"))


def _as_text(objects: DataFrame) -> DataFrame:
    return objects.select("pipeline_id", "checkpoint_id", F.col("content").cast("string").alias("data"))


def _named(objects: DataFrame, suffix: str) -> DataFrame:
    """Whole files with the names of their folder and their own."""
    steps = F.split(F.col("_metadata.file_path"), "/")
    name = _file_name(F.element_at(steps, -1))
    return objects.select(
        _file_name(F.element_at(steps, -2)).alias("pipeline_id"),
        F.substring(name, F.lit(1), F.length(name) - F.lit(len(suffix))).alias("checkpoint_id"),
        F.col("content").cast("string").alias("data"),
    )


def _file_name(step: Column) -> Column:
    """A step of a path as it was named: percent signs decoded, a plus left alone."""
    return F.url_decode(F.replace(step, F.lit("+"), F.lit("%2B")))
