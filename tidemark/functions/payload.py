"""JSON text of a progress record and its parts."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.times import iso_text

EMPTY_OBJECT = "{}"

METADATA_WRITE_RULES = ("empty_object", "empty_as_null", "null_only", "json_null")
METADATA_READ_RULES = ("empty_object", "keep_null")


def json_string(column: str | Column) -> Column:
    """A text as a quoted and escaped JSON string; null stays null."""
    column = F.col(column) if isinstance(column, str) else column
    wrapped = F.to_json(F.struct(column.cast("string").alias("v")))
    # {"v":"text"}  ->  "text"
    return F.when(
        column.isNotNull(), F.substring(wrapped, F.lit(6), F.length(wrapped) - F.lit(6))
    )


def integral_offset(offset_json: str | Column) -> Column:
    """The offset as a number when its JSON text is an integer, else null."""
    column = F.col(offset_json) if isinstance(offset_json, str) else offset_json
    return F.when(column.rlike("^-?[0-9]+$"), column.try_cast("bigint"))


def offset_from(column: str | Column, kind: str) -> Column:
    """Offset JSON text from a column that holds it as ``json``, ``text`` or ``int``.

    ``json``: the column is JSON text already.  ``text``: the column is plain text
    and stays text.  ``int``: a number, or the digits of one.
    """
    column = F.col(column) if isinstance(column, str) else column
    if kind == "json":
        return column.cast("string")
    if kind == "text":
        return json_string(column)
    if kind == "int":
        return column.try_cast("bigint").cast("string")
    raise ValueError(f"unknown offset kind {kind!r}; one of ('json', 'text', 'int')")


def metadata_on_write(column: str | Column, rule: str) -> Column:
    """Metadata text to store under a write rule."""
    column = F.col(column) if isinstance(column, str) else column
    empty = column.isNull() | (column == EMPTY_OBJECT)
    if rule == "empty_object":
        return F.coalesce(column, F.lit(EMPTY_OBJECT))
    if rule == "empty_as_null":
        return F.when(~empty, column)
    if rule == "null_only":
        return column
    if rule == "json_null":
        return F.coalesce(column, F.lit("null"))
    raise ValueError(f"unknown write rule {rule!r}; one of {METADATA_WRITE_RULES}")


def metadata_on_read(column: str | Column, rule: str) -> Column:
    """Metadata text handed out under a read rule; JSON null counts as null."""
    column = F.col(column) if isinstance(column, str) else column
    value = F.nullif(column, F.lit("null"))
    if rule == "empty_object":
        return F.coalesce(value, F.lit(EMPTY_OBJECT))
    if rule == "keep_null":
        return value
    raise ValueError(f"unknown read rule {rule!r}; one of {METADATA_READ_RULES}")


def payload_text(extra: Sequence[str] = (), expiry: str | None = None) -> Column:
    """The record of a row as one JSON object.

    Five fields always: ``stream_id, offset, metadata, created_at, updated_at``;
    then the text columns ``extra``; then ``_expires_at`` (epoch seconds) where the
    column ``expiry`` is set.  Offset and metadata are JSON text already and are
    put in as they are, so nothing in them is re-encoded.
    """
    null = F.lit("null")

    def quoted(text: Column) -> Column:
        return F.coalesce(F.concat(F.lit('"'), text, F.lit('"')), null)

    pieces = [
        F.lit('{"stream_id":'), F.coalesce(json_string("stream_id"), null),
        F.lit(',"offset":'), F.coalesce(F.col("offset_json"), null),
        F.lit(',"metadata":'), F.coalesce(F.col("metadata"), F.lit(EMPTY_OBJECT)),
        F.lit(',"created_at":'), quoted(iso_text("created_at")),
        F.lit(',"updated_at":'), quoted(iso_text("updated_at")),
    ]
    for name in extra:
        pieces += [F.lit(f',"{name}":'), F.coalesce(json_string(name), null)]
    if expiry:
        seconds = (F.unix_micros(expiry) / F.lit(1000000)).cast("decimal(20,6)").cast("string")
        pieces.append(F.coalesce(F.concat(F.lit(',"_expires_at":'), seconds), F.lit("")))
    return F.concat(*pieces, F.lit("}"))
