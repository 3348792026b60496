"""Storage keys of whole tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import key_tail, key_text, stable_id
from tidemark.schema import KEY_COLS


def with_key(
    df: DataFrame,
    layout: str = "colon",
    prefix: str | None = None,
    key_cols: Sequence[str] = KEY_COLS,
    suffix: str = "",
    name: str = "key",
) -> DataFrame:
    """Add the storage key of every row (layouts: ``functions.KEY_LAYOUTS``)."""
    return df.withColumn(name, key_text(key_cols, layout, prefix, suffix))


def split_key(
    df: DataFrame,
    prefix: str = "",
    suffix: str = "",
    key: str = "key",
    name: str = "key_tail",
) -> DataFrame:
    """Add the last part of every key: the key without ``prefix`` and ``suffix``."""
    return df.withColumn(name, key_tail(key, prefix, suffix))


def rekey_report(
    df: DataFrame,
    layout: str,
    prefix: str | None = None,
    key_cols: Sequence[str] = KEY_COLS,
    suffix: str = "",
) -> DataFrame:
    """Keys of ``layout`` that more than one source key would share.

    Repeats of a source key are dropped before the shuffle on the new key, so what
    a reducer gets for one new key is a count per task.
    """
    return (
        df.select(*key_cols)
        .distinct()
        .groupBy(key_text(key_cols, layout, prefix, suffix).alias("key"))
        .agg(F.count(F.lit(1)).alias("n_sources"))
        .where(F.col("n_sources") > 1)
    )


def with_stable_id(df: DataFrame, key: str = "key", name: str = "stable_id") -> DataFrame:
    """Add a hashed identifier of the key that every process computes alike."""
    return df.withColumn(name, stable_id(key))
