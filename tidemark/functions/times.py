"""Times as ISO text, as epoch numbers and as timestamps.

Timestamps are instants; text without an offset is UTC, so sessions run with
``spark.sql.session.timeZone=UTC``.
"""

from datetime import UTC, date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: six fraction digits, as ``datetime.isoformat`` writes them.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

TIME_FORMATS = ("iso", "epoch_s", "epoch_ms", "native")


def moment(value: str | datetime | date | Column) -> Column:
    """A point in time given by the caller; operators never read the clock.

    Without a zone it is UTC, whatever the zone of the driver.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime) and value.tzinfo is None:
        value = value.replace(tzinfo=UTC)
    return F.lit(value).cast("timestamp")


def iso_text(column: str | Column) -> Column:
    """ISO text with microseconds (``to_json`` would keep milliseconds only)."""
    return F.date_format(column, ISO_PATTERN)


def parse_time(column: str | Column, fmt: str) -> Column:
    """Timestamp from text or number; unreadable text gives null."""
    column = F.col(column) if isinstance(column, str) else column
    if fmt == "iso":
        # The cast reads both the form with a fraction and the one without, with or
        # without a zone offset; a time without a date it would complete by the clock.
        dated = column.cast("string").rlike(r"^\s*[0-9]{4}-[0-9]{1,2}")
        return F.when(dated, column.try_cast("timestamp"))
    if fmt == "epoch_s":
        return F.timestamp_micros(F.round(column.try_cast("double") * F.lit(1000000)).cast("bigint"))
    if fmt == "epoch_ms":
        return F.timestamp_millis(column.try_cast("bigint"))
    if fmt == "native":
        return column.cast("timestamp")
    raise ValueError(f"unknown time format {fmt!r}; one of {TIME_FORMATS}")


def format_time(column: str | Column, fmt: str) -> Column:
    """The inverse of :func:`parse_time`."""
    column = F.col(column) if isinstance(column, str) else column
    if fmt == "iso":
        return iso_text(column)
    if fmt == "epoch_s":
        return F.unix_micros(column.cast("timestamp")) / F.lit(1000000.0)
    if fmt == "epoch_ms":
        return F.unix_millis(column.cast("timestamp"))
    if fmt == "native":
        return column.cast("timestamp")
    raise ValueError(f"unknown time format {fmt!r}; one of {TIME_FORMATS}")
