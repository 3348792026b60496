"""Op 10: the exact number of tokens of every prefix of every text.

The counts are stored once; how long a text is in tokens, where to cut it for a budget and
what a cut costs are then look-ups (`tokens_at`, `cut_for`), without encoding again.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import PrefixCounts
from tidemark.llm.shipping import ship
from tidemark.llm.words import text_slices

_counters: dict[str, PrefixCounts] = {}


def prefix_counts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, n_bytes, prefix_counts`` for every row of ``docs``.

    ``prefix_counts[k]`` is the number of tokens of the first ``k + 1`` characters, as the
    tokenizer in file ``tokenizer`` gives it for that prefix alone. Rows are handled where
    they are read; nothing is shuffled. Null and empty texts have 0 bytes and no entries;
    repeated rows and null ids stay; other columns are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _counters:
            _counters[tokenizer] = PrefixCounts(tokenizer)
        counter = _counters[tokenizer]
        for batch in batches:
            texts = batch.column(2).fill_null("")
            for start, stop in text_slices(texts):
                found = [counter.encode(t) for t in texts.slice(start, stop - start).to_pylist()]
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                values = pa.array(np.concatenate(found) if found else np.zeros(0, np.int32))
                rows = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.ListArray.from_arrays(pa.array(ends), values)],
                    ["id", "n_bytes", "prefix_counts"],
                )

    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text_col).alias("text"),
    )
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes long, prefix_counts array<int>")
    return counted.withColumnRenamed("id", id_col)


def tokens_at(counts: Column, length: Column | int) -> Column:
    """Tokens of the first ``length`` characters; 0 for none, those of the text beyond it."""
    length = F.lit(length) if isinstance(length, int) else length
    at = F.least(length, F.size(counts))
    return F.when(at > 0, F.try_element_at(counts, at.cast("int"))).otherwise(0).cast("long")


def cut_for(counts: Column, budget: int) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    fits = F.transform(counts, lambda n, i: F.when(n <= budget, i + 1).otherwise(0))
    return F.coalesce(F.array_max(fits), F.lit(0))


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` from the prefix counts of whole texts."""
    counted = prefix_counts(docs, tokenizer, id_col, text_col)
    n = F.coalesce(F.try_element_at("prefix_counts", F.lit(-1)), F.lit(0)).cast("long")
    return counted.select(id_col, "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
