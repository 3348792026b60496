"""Column names and types of progress tables and progress logs.

A *progress table* has one row per key and says how far reading of that key's
stream has got.  A *progress log* is the append-only history it is derived
from: the same columns plus what happened (``op``) and in which order (``seq``).
"""

from pyspark.sql import types as T

#: Default key.  Every operator takes ``key_cols``, so other grains
#: (one column, or three with ``partition``) work the same way.
KEY_COLS = ["pipeline_id", "stream_id"]

SAVE = "save"
DELETE = "delete"

_FIELDS = [
    T.StructField("pipeline_id", T.StringType(), False),
    T.StructField("stream_id", T.StringType(), False),
    T.StructField("partition", T.StringType()),
    # Any JSON value is a legal offset; the text keeps it without loss and the
    # number is there for comparison when the value is an integer.
    T.StructField("offset_json", T.StringType(), False),
    T.StructField("offset_num", T.LongType()),
    # JSON text: the values of one object have mixed types.
    T.StructField("metadata", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType(), False),
    T.StructField("expires_at", T.TimestampType()),
]

#: One row per key.
PROGRESS = T.StructType(_FIELDS)

#: One row per event.
PROGRESS_LOG = T.StructType(
    _FIELDS
    + [
        T.StructField("op", T.StringType(), False),
        T.StructField("seq", T.LongType(), False),
    ]
)
