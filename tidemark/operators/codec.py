"""Payload encoding and decoding, and the normal form of offsets, metadata and times."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    integral_offset,
    metadata_on_read,
    metadata_on_write,
    moment,
    offset_from,
    parse_time,
    payload_text,
)

_PAYLOAD_FIELDS = (
    "stream_id STRING, offset VARIANT, metadata STRING, created_at STRING, "
    "updated_at STRING, _expires_at DOUBLE, _corrupt STRING"
)


def encode_payloads(
    df: DataFrame,
    name: str = "data",
    extra: Sequence[str] = (),
    expiry: str | None = None,
) -> DataFrame:
    """Add the JSON payload of every row.

    ``extra`` names further text columns to put in; ``expiry`` the column that
    holds the end of life, stored as epoch seconds where it is set.
    """
    return df.withColumn(name, payload_text(extra, expiry))


def decode_payloads(
    df: DataFrame,
    data: str = "data",
    mode: str = "permissive",
    extra: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Typed rows from payloads, as text or UTF-8 bytes: ``(good, bad)``.

    A payload is bad when it is no JSON object, lacks its stream, offset or update
    time, or has a time that cannot be read; a row without a payload is bad too.
    ``permissive`` keeps such rows apart, in ``bad``; ``failfast`` makes the query
    that meets one fail.  Missing metadata reads as ``{}``.

    The other columns of ``df`` stay; ``extra`` names further text fields of the
    payload to take out.
    """
    if mode not in ("permissive", "failfast"):
        raise ValueError(f"unknown mode {mode!r}; one of ('permissive', 'failfast')")
    # Malformed bytes read as null, so that the row is a bad one.
    binary = dict(df.dtypes)[data] == "binary"
    text = F.try_validate_utf8(F.col(data).cast("string")) if binary else F.col(data)
    schema = ", ".join([_PAYLOAD_FIELDS, *[f"`{name}` STRING" for name in extra]])
    # Spark repeats an expression in a filter placed above it; behind a generator the
    # payload is parsed once.
    record = F.from_json(text, schema, {"columnNameOfCorruptRecord": "_corrupt"})
    parsed = df.select(*[F.col(c) for c in df.columns], F.explode(F.array(record)).alias("_p"))

    # A variant keeps a string apart from a number, but sorts the fields of objects
    # and trims fractions; for those the text of the payload is taken.
    as_written = F.schema_of_variant("_p.offset").rlike("^(OBJECT|ARRAY|DOUBLE|FLOAT|DECIMAL)")
    fields = {
        "stream_id": F.col("_p.stream_id"),
        "offset_json": F.when(as_written, F.get_json_object(text, "$.offset")).otherwise(
            F.to_json("_p.offset")
        ),
        "metadata": metadata_on_read("_p.metadata", "empty_object"),
        "created_at": parse_time("_p.created_at", "iso"),
        "updated_at": parse_time("_p.updated_at", "iso"),
        "expires_at": parse_time("_p._expires_at", "epoch_s"),
        **{name: F.col(f"_p.{name}") for name in extra},
    }
    unreadable = (
        F.col("_p").isNull()
        | F.col("_p._corrupt").isNotNull()
        | F.col("_p.stream_id").isNull()
        | F.col("_p.offset").isNull()
        | fields["updated_at"].isNull()
        | (F.col("_p.created_at").isNotNull() & fields["created_at"].isNull())
    )
    kept = [c for c in df.columns if c != data and c not in fields and c != "offset_num"]

    def typed(rows: DataFrame) -> DataFrame:
        columns = [F.col(c) for c in kept] + [c.alias(name) for name, c in fields.items()]
        offset_num = integral_offset("offset_json").alias("offset_num")
        return rows.select(*columns).select(*kept, *fields, offset_num)

    if mode == "failfast":
        refusal = F.concat(F.lit("unreadable payload: "), F.coalesce(text, F.lit("null")))
        checked = F.when(unreadable, F.raise_error(refusal)).otherwise(F.col("_p"))
        return typed(parsed.withColumn("_p", checked)), df.limit(0)
    return typed(parsed.where(~unreadable)), parsed.where(unreadable).select(*df.columns)


def normalise_offsets(df: DataFrame, kind: str = "json", column: str = "offset") -> DataFrame:
    """Replace ``column`` by ``offset_json`` and ``offset_num``.

    ``kind`` says what the column holds: ``json`` text, plain ``text`` that stays
    text, or ``int`` (numbers or their digits).
    """
    text = offset_from(column, kind)
    others = [F.col(c) for c in df.columns if c not in (column, "offset_json", "offset_num")]
    return df.select(
        *others, text.alias("offset_json"), integral_offset(text).alias("offset_num")
    )


def normalise_metadata(
    df: DataFrame,
    write: str | None = None,
    read: str | None = None,
    column: str = "metadata",
) -> DataFrame:
    """Apply a write rule, a read rule, or one after the other, to the metadata text."""
    value = F.col(column)
    if write is not None:
        value = metadata_on_write(value, write)
    if read is not None:
        value = metadata_on_read(value, read)
    return df.withColumn(column, value)


def normalise_times(df: DataFrame, column: str, fmt: str) -> DataFrame:
    """Turn a time column (``iso``, ``epoch_s``, ``epoch_ms``, ``native``) into a timestamp."""
    return df.withColumn(column, parse_time(column, fmt))


def strip_system_fields(df: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Drop the fields a storage system adds: names with a leading ``_`` or in ``also``."""
    return df.drop(*[c for c in df.columns if c.startswith("_") or c in also])


def stamp_updated_at(
    df: DataFrame, as_of, policy: str = "always", column: str = "updated_at"
) -> DataFrame:
    """Set the update time to ``as_of``: ``always``, or only ``if_null``."""
    if policy == "always":
        return df.withColumn(column, moment(as_of))
    if policy == "if_null":
        return df.withColumn(column, F.coalesce(F.col(column), moment(as_of)))
    raise ValueError(f"unknown policy {policy!r}; one of ('always', 'if_null')")


def with_payload_column(
    df: DataFrame, name: str = "payload", source: str = "metadata"
) -> DataFrame:
    """Add a copy of the JSON in ``source`` as a column of its own; null reads ``{}``."""
    return df.withColumn(name, F.coalesce(F.col(source), F.lit("{}")))


def with_copied_column(df: DataFrame, name: str, source: str) -> DataFrame:
    """Add ``source`` once more under ``name``, e.g. a key column as a record's ``id``."""
    return df.withColumn(name, F.col(source))
