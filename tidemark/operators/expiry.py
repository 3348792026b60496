"""Expiry.  A row without ``expires_at`` never expires."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import moment


def stamp_expiry(
    df: DataFrame,
    ttl_seconds: int | str | Column | None,
    as_of=None,
    saved_at: str = "updated_at",
) -> DataFrame:
    """Set ``expires_at`` to the save time plus the time to live.

    ``ttl_seconds`` is a number, or a column (name) with one per row; null means
    never, zero at once, and a negative one is over already.  The save time is
    ``as_of``, or each row's ``saved_at``.
    """
    if ttl_seconds is None:
        return df.withColumn("expires_at", F.lit(None).cast("timestamp"))
    ttl = F.col(ttl_seconds) if isinstance(ttl_seconds, str) else ttl_seconds
    ttl = ttl if isinstance(ttl, Column) else F.lit(ttl)
    saved = F.col(saved_at) if as_of is None else moment(as_of)
    return df.withColumn("expires_at", F.timestamp_add("SECOND", ttl, saved))


def live(table: DataFrame, as_of, boundary: str = "expired") -> DataFrame:
    """Rows still alive at ``as_of``.

    ``boundary`` says what a row is at the very instant it expires: ``expired``
    (alive while ``expires_at > as_of``) or ``live`` (``>=``).
    """
    return table.where(_alive(as_of, boundary))


def mark_expired(table: DataFrame, as_of, boundary: str = "expired") -> DataFrame:
    """The table with a column ``expired``: what :func:`purge_expired` takes apart."""
    return table.withColumn("expired", ~_alive(as_of, boundary))


def purge_expired(
    table: DataFrame, as_of, boundary: str = "expired"
) -> tuple[DataFrame, DataFrame]:
    """The table without its expired rows, and those rows: ``(kept, purged)``.

    Writing both computes the table twice; :func:`write_purged` computes it once.
    """
    alive = _alive(as_of, boundary)
    return table.where(alive), table.where(~alive)


def write_purged(
    table: DataFrame, path: str, as_of, boundary: str = "expired"
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Write a table with its expired rows apart, in one pass: ``(kept, purged, counts)``.

    The rows go to ``path/expired=false`` and ``path/expired=true``; the two tables read one
    folder each.  ``counts`` holds the numbers of rows ``kept`` and ``purged``, counted while
    they were written.
    """
    name = "expired"
    if name in table.columns:
        raise ValueError(f"the table has a column {name!r} of its own")
    seen = Observation()
    marked = mark_expired(table, as_of, boundary).observe(
        seen,
        F.count(F.when(~F.col(name), 1)).alias("kept"),
        F.count(F.when(F.col(name), 1)).alias("purged"),
    )
    marked.write.mode("overwrite").partitionBy(name).parquet(path)
    stored = table.sparkSession.read.schema(T.StructType([*table.schema, T.StructField(name, T.BooleanType())])).parquet(path)
    return stored.where(~F.col(name)).drop(name), stored.where(F.col(name)).drop(name), dict(seen.get)


def list_live(
    table: DataFrame,
    as_of,
    group: tuple[str, str] | None = None,
    boundary: str = "expired",
) -> DataFrame:
    """Live rows of all groups, or of one given as ``(column, value)``."""
    if group is not None:
        column, value = group
        table = table.where(F.col(column) == value)
    return live(table, as_of, boundary)


def _alive(as_of, boundary: str) -> Column:
    expiry = F.col("expires_at")
    if boundary == "expired":
        after = expiry > moment(as_of)
    elif boundary == "live":
        after = expiry >= moment(as_of)
    else:
        raise ValueError(f"unknown boundary {boundary!r}; one of ('expired', 'live')")
    return expiry.isNull() | after
