"""One change event per save."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import json_string
from tidemark.schema import KEY_COLS, SAVE

#: Fixed value: what the event is called.
SAVED = "checkpoint_saved"


def change_events(
    changes: DataFrame, key_cols: Sequence[str] = KEY_COLS, name: str = "event"
) -> DataFrame:
    """The saves in ``changes`` as JSON notifications, batch or stream.

    Each has the fields ``event``, the key columns and ``offset``.
    """
    if "op" in changes.columns:
        changes = changes.where(F.col("op") == SAVE)
    pieces = [F.lit(f'{{"event":"{SAVED}"')]
    for column in key_cols:
        pieces += [F.lit(f',"{column}":'), F.coalesce(json_string(column), F.lit("null"))]
    pieces += [F.lit(',"offset":'), F.col("offset_json"), F.lit("}")]
    return changes.select(*key_cols, F.concat(*pieces).alias(name))
