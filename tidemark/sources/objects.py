"""Trees with one object per file, listed and read by tasks: the driver holds no list of them."""

import os
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import scratch_path

#: An object by its folder, from the root of the tree on, and its name; without a name, a folder to be listed.
NAMES = "folder STRING, name STRING"

_OBJECTS = "pipeline_id STRING, checkpoint_id STRING, content BINARY"

#: Rows and bytes after which a task hands over what it has.
_ROWS, _BYTES = 1_000, 8 << 20

#: What Spark's readers take for a pattern.
_PATTERN = r"[*?\[\]{}\\]"


def tree_root(spark: SparkSession, path: str, suffix: str, folder: str | None = None) -> str | None:
    """Where tasks find a tree (or one ``folder`` of it), or nothing if Spark has to look it up.

    That is so for patterns, for storage that pyarrow does not know and for what is no folder there.
    """
    if re.search(_PATTERN, path + suffix):
        return None
    place = spark._jvm.org.apache.hadoop.fs.Path(path if folder is None else f"{path}/{folder}")
    uri = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri()
    # Local paths are taken as they are, others with their escapes.
    root = uri.getPath() if uri.getScheme() == "file" else uri.toString()
    try:
        files, base = FileSystem.from_uri(root)
        found = files.get_file_info(base).type
    except (OSError, pa.ArrowException):
        return None
    return root if found == FileType.Directory else None


def list_objects(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """Every object of a tree that Spark's readers would read, as ``NAMES``.

    One task lists the root, and the folders found there are dealt out; a task goes through each of
    its own with all that lies below.  On a local file system a folder's entries are never together
    in memory.
    """

    def listed(deep: bool) -> Callable:
        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files, base = FileSystem.from_uri(root)

            def names() -> Iterator[tuple]:
                for folder, name in _rows(batches):
                    if name is None:
                        yield from _below(files, base, folder, suffix, deep)
                    else:
                        yield folder, name

            held = []
            for row in names():
                held.append(row)
                if len(held) == _ROWS:
                    yield _batch(held, [pa.string(), pa.string()], ["folder", "name"])
                    held = []
            if held:
                yield _batch(held, [pa.string(), pa.string()], ["folder", "name"])

        return work

    start = spark.range(0, 1, 1, 1).select(F.lit("").alias("folder"), F.lit(None).cast("string").alias("name"))
    top = start.mapInArrow(listed(False), NAMES)
    return top.repartition(_cores(spark)).mapInArrow(listed(True), NAMES)


def read_names(names: DataFrame, root: str, suffix: str, tasks: int, skip_missing: bool) -> DataFrame:
    """The objects of ``names``, as bytes, beside the names of their folder and their own."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = FileSystem.from_uri(root)
        types, columns = [pa.string(), pa.string(), pa.binary()], ["pipeline_id", "checkpoint_id", "content"]
        held, size = [], 0
        for folder, name in _rows(batches):
            place = f"{base}/{folder}" if folder else base
            try:
                # As it is stored, whatever its name says of compression.
                with files.open_input_stream(f"{place}/{name}", compression=None) as body:
                    content = body.read()
            except FileNotFoundError:
                if skip_missing:
                    continue
                raise
            held.append((place.rstrip("/").rsplit("/", 1)[-1], name[: len(name) - len(suffix)], content))
            size += len(content)
            if len(held) == _ROWS or size >= _BYTES:
                yield _batch(held, types, columns)
                held, size = [], 0
        if held:
            yield _batch(held, types, columns)

    return names.repartition(tasks).mapInArrow(work, _OBJECTS)


def read_tree(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """All objects of a tree: those that are there now, with what they hold when they are read."""
    place = scratch_path(spark, "names")
    list_objects(spark, root, suffix).write.parquet(place)
    names = spark.read.schema(NAMES).parquet(place)
    number = names.count()
    tasks = max(1, min(_cores(spark), -(-number // 100)), -(-number // 10_000))
    skip = spark.conf.get("spark.sql.files.ignoreMissingFiles") == "true"
    return read_names(names, root, suffix, tasks, skip)


def stream_lists(spark: SparkSession, root: str, suffix: str, lists: str) -> DataFrame:
    """The objects of one list after the other, as a stream; what is gone by then is passed over."""
    names = spark.readStream.schema(NAMES).option("maxFilesPerTrigger", 1).parquet(lists)
    return read_names(names, root, suffix, _cores(spark), True)


def list_new_objects(
    spark: SparkSession, path: str, lists: str, suffix: str = ".json", files_per_list: int = 10_000
) -> int:
    """Add the objects of a tree that no list in the folder ``lists`` names yet; returns their number.

    Tasks list the tree and compare it with the lists, and a file of ``lists`` holds at most
    ``files_per_list`` names.  A call that was broken off has added some whole lists or none; the next
    adds the others.  One process at a time adds to a folder of lists; streams may read it meanwhile.
    """
    root = tree_root(spark, path, suffix)
    if root is None:
        raise ValueError(f"tasks cannot list {path!r}; stream it without lists")
    place = spark._jvm.org.apache.hadoop.fs.Path(lists)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    known = spark.read.schema(NAMES).parquet(lists)
    # Never broadcast: that would bring all names to the driver.
    new = list_objects(spark, root, suffix).join(known.hint("merge"), ["folder", "name"], "left_anti")
    found = scratch_path(spark, "new-names")
    new.write.parquet(found)
    names = spark.read.schema(NAMES).parquet(found)
    number = names.count()
    if number:
        # A task leaves one list that is not full.
        tasks = -(-number // (8 * files_per_list))
        names.repartition(tasks).write.mode("append").option("maxRecordsPerFile", files_per_list).parquet(lists)
    return number


def _below(files: FileSystem, base: str, folder: str, suffix: str, deep: bool) -> Iterator[tuple[str, str | None]]:
    """The objects of a folder and, if not ``deep``, its folders, which are gone through otherwise."""
    todo = [folder]
    while todo:
        at = todo.pop()
        for name, is_folder, size in _entries(files, f"{base}/{at}" if at else base):
            if is_folder:
                below = f"{at}/{name}" if at else name
                if _hidden(name) and not name.startswith(("_metadata", "_common_metadata")):
                    continue
                if deep:
                    todo.append(below)
                else:
                    yield below, None
            # Spark reads no empty files.
            elif size and name.endswith(suffix) and not _hidden(name):
                yield at, name


def _entries(files: FileSystem, place: str) -> Iterator[tuple[str, bool, int]]:
    """Names in a folder, whether they are folders, and their sizes."""
    if not isinstance(files, LocalFileSystem):
        for info in files.get_file_info(FileSelector(place)):
            yield info.base_name, info.type == FileType.Directory, info.size
        return
    with os.scandir(place) as entries:
        for entry in entries:
            try:
                found = entry.name, entry.is_dir(), entry.stat().st_size
            except FileNotFoundError:
                # Gone by now, or a link to nothing.
                continue
            yield found


def _hidden(name: str) -> bool:
    """What Spark's readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, str | None]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def _batch(rows: list[tuple], types: list[pa.DataType], columns: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], columns)


def _cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism
