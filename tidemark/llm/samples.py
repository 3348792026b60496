"""Labelled rows for fitting: what is held out, and samples of bounded size."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``; 0 for a null id."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % folds).cast("int")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, allowed: Column, most: int, id_col: str, value: Column, name: str
) -> DataFrame:
    """``id, label, name`` of at most ``most`` labelled ids for which ``allowed`` holds, one row
    for each: of a repeated id the row with the least ``value``.

    The ids with the smallest hash, so the same ones in every run. They are few by construction
    and are sent to the rows, which are not shuffled.
    """
    picked = (
        labels.where(allowed & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).cast("double").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most)
    )
    rows = docs.select(F.col(id_col).alias("id"), value.alias(name))
    return rows.join(F.broadcast(picked), "id").groupBy("id", "label").agg(F.min(name).alias(name))


def unlabelled_sample(docs: DataFrame, allowed: Column, most: int, id_col: str, value: Column, name: str) -> DataFrame:
    """``id, name`` of at most ``most`` ids of ``docs``, whatever their labels; one row for each."""
    picked = (
        docs.where(allowed & F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("id"))
        .distinct()
        .orderBy(F.xxhash64("id"), "id")
        .limit(most)
    )
    rows = docs.select(F.col(id_col).alias("id"), value.alias(name))
    return rows.join(F.broadcast(picked), "id").groupBy("id").agg(F.min(name).alias(name))
