"""Parquet tables: creation, append-only logs, payload tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.codec import decode_payloads
from tidemark.plans import path_exists
from tidemark.schema import KEY_COLS, PROGRESS, PROGRESS_LOG


def ensure_table(
    spark: SparkSession,
    name: str,
    key_cols: Sequence[str] = KEY_COLS,
    schema: T.StructType = PROGRESS,
    buckets: int | None = None,
    location: str | None = None,
) -> DataFrame:
    """Create a table if there is none yet, and return it.

    ``name`` is a name in the catalog or, with a slash in it, the path of a Parquet
    table.  With ``location`` the files of a catalog table are there, otherwise in the
    warehouse.

    With ``buckets`` it is bucketed and sorted by its key, so that joins of two
    such tables need no shuffle.  Spark does not enforce keys: check them with
    ``duplicate_keys``.
    """
    unknown = [c for c in key_cols if c not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"key columns {unknown} are not in the schema")
    if "/" in name:
        if not path_exists(spark, name):
            spark.createDataFrame([], schema).write.parquet(name)
        return spark.read.schema(schema).parquet(name)
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
        for f in schema
    )
    clustering = ""
    if buckets:
        keys = ", ".join(f"`{c}`" for c in key_cols)
        clustering = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(buckets)} BUCKETS"
    place = ""
    if location:
        quoted = location.replace("\\", "\\\\").replace("'", "\\'")
        place = f" LOCATION '{quoted}'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{clustering}{place}")
    return spark.table(name)


def append_log(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add events to a log; what is there is never touched.

    Every task writes its own rows, so nothing is shuffled.
    """
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType = PROGRESS_LOG) -> DataFrame:
    """A log as written by :func:`append_log` or by a stream."""
    return spark.read.schema(schema).parquet(path)


def read_payload_table(
    table: DataFrame, data_col: str = "data", mode: str = "permissive"
) -> tuple[DataFrame, DataFrame]:
    """Typed rows of a table of keys and payloads: ``(good, bad)``."""
    return decode_payloads(table, data_col, mode)


def write_sorted(
    df: DataFrame, path: str, key_cols: Sequence[str] = KEY_COLS, mode: str = "errorifexists"
) -> None:
    """Write a table ordered by key.

    Every file holds its own range of keys, so a lookup of a key, a prefix or a
    range skips all other files by their statistics.  Within that range a Bloom filter of
    each key column, sized by the values found, tells that a key is absent: a lookup of one
    that is not there reads no row group.
    """
    writer = df.orderBy(*key_cols).write.mode(mode)
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for name in key_cols:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(path)
