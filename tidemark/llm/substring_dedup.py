"""Op 6: removal of long passages that occur more than once, by level-wise doubling.

A run of words can only be repeated if each shorter run within it is. So runs of half the
window are compared first, and only where one of them is repeated is it extended to twice that
length, the window itself, and compared again.

Of the short runs of a window only the one with the smallest hash is compared: it depends on
nothing but the window's words, so equal windows choose equal runs, and about a tenth of the
positions are enough to miss no repeated window.
"""

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shipping import ship
from tidemark.llm.storage import written
from tidemark.llm.words import text_buffers, text_slices, window_hashes, word_bounds, word_hashes

WINDOW = 35

#: Two odd numbers: bases of two independent word hashes.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _choices(words: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows that lie within one text, for each the start of the short run it
    chooses (the first of the smallest), and the hashes of all short runs."""
    short = (window + 1) // 2
    runs = window_hashes(words, short)
    if len(words) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), runs
    ends = np.repeat(offsets[1:], np.diff(offsets))
    starts = np.flatnonzero(np.arange(len(words)) + window <= ends)
    inside = np.lib.stride_tricks.sliding_window_view(runs, window - short + 1)
    return starts, starts + inside[starts].argmin(axis=1), runs


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[tuple]:
    data, offsets = text_buffers(batch.column(text))
    for start, stop in text_slices(batch.column(text)):
        bounds = word_bounds(data, offsets[start : stop + 1])
        yield start, stop, data, *bounds


def _anchors(window: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in (0, 1)]
            for first, _, data, starts, ends, offsets in _slices(batch, 2):
                words = word_hashes(data, starts, ends, _BASES[0])
                _, chosen, runs = _choices(words, offsets, window)
                chosen = np.unique(chosen)
                row = np.searchsorted(offsets, chosen, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(runs[chosen].view(np.int64)),
                        pa.array(keys[0][first + row]),
                        pa.array(keys[1][first + row]),
                        pa.array((chosen - offsets[row]).astype(np.int32)),
                    ],
                    ["run", "k1", "k2", "at"],
                )

    return emit


def _windows(window: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in (1, 2)]
            for first, stop, data, starts, ends, offsets in _slices(batch, 3):
                words = [word_hashes(data, starts, ends, base) for base in _BASES]
                at, chosen, _ = _choices(words[0], offsets, window)
                alive = np.zeros(len(starts) + 1, dtype=bool)
                alive[_places(batch.column(4), first, stop, offsets)] = True
                at = at[alive[chosen]]
                row = np.searchsorted(offsets, at, side="right") - 1
                one, two = (window_hashes(w, window)[at] for w in words)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.view(np.int64)),
                        pa.array((two >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                        pa.array(keys[0][first + row]),
                        pa.array(keys[1][first + row]),
                        pa.array((at - offsets[row]).astype(np.int32)),
                    ],
                    ["ha", "hb", "k1", "k2", "at"],
                )

    return emit


def _places(lists: pa.Array, first: int, stop: int, offsets: np.ndarray) -> np.ndarray:
    """Word numbers within the slice of the positions listed for its texts."""
    part = lists.slice(first, stop - first)
    sizes = part.value_lengths().fill_null(0).to_numpy()
    return np.repeat(offsets[:-1], sizes) + part.flatten().to_numpy()


def _removed(window: int, as_is: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, starts, ends, offsets in _slices(batch, 3):
                at = _places(batch.column(4), first, stop, offsets)
                # Repeated starts are listed once, so a step up or down is one at most.
                steps = np.zeros(len(starts) + 1, dtype=np.int64)
                np.add.at(steps, at, 1)
                np.add.at(steps, at + window, -1)
                keep = np.cumsum(steps[:-1]) == 0
                kept = []
                low = 0
                for high, text in zip(offsets[1:].tolist(), batch.column(3).slice(first, stop - first)):
                    text, stays = text.as_py() or "", keep[low:high]
                    if not (as_is and stays.all()):
                        text = b" ".join(compress(text.encode().split(), stays)).decode()
                    kept.append(text)
                    low = high
                n_kept = np.concatenate([[0], np.cumsum(keep)])[offsets]
                n_words = np.diff(offsets).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, stop - first),
                        pa.array(n_words),
                        pa.array(n_words - np.diff(n_kept).astype(np.int64)),
                        pa.array(kept, pa.string()),
                    ],
                    ["row", "n_words", "n_removed", "kept_text"],
                )

    return emit


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_columns: tuple[str, ...] = (),
    as_is: bool = False,
) -> DataFrame:
    """``id_col, n_words, n_removed, kept_text`` (and ``keep_columns``) for every row of ``docs``.

    A word is a longest run of characters other than ASCII white space. Every word is removed
    that lies in a window of ``window`` words whose word sequence also starts anywhere else, in
    another row, in the same text or in a copy; all occurrences go, the first as well.
    ``kept_text`` is what is left, joined by one space; with ``as_is``, a text of which nothing
    is removed stays as it is. Windows are compared by 96-bit hashes.

    Null texts have no words. Null ids and repeated rows stay (a repeated row repeats its
    windows); other columns are not read. An empty table gives no rows.

    Repeats are counted before the shuffle (one row per hash and task), so a passage found in
    a third of all texts costs no more than others; joins on hashes have one row per hash on
    one side. The repeated hashes of each length and the positions that it leaves are tables in
    the shared folder; the shuffles before them are freed.
    """
    if window < 2:
        raise ValueError("window must be at least 2 words")
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.struct(F.col(id_col).alias("id"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(keep_columns)])
    # Two rows with one key have equal ids and texts, and so equal results.
    keyed = docs.select(
        row.alias("row"), F.xxhash64(id_col).alias("k1"), F.xxhash64(text).alias("k2"), text.alias("text")
    )

    anchors = keyed.select("k1", "k2", "text").mapInArrow(
        _anchors(window), "run long, k1 long, k2 long, at int"
    )
    repeated = written(_repeated(anchors, "run"), "repeated")
    alive = written(_lists(anchors.join(repeated, "run", "left_semi")), "runs")

    windows = keyed.join(alive, ["k1", "k2"]).select("row", "k1", "k2", "text", "places").mapInArrow(
        _windows(window), "ha long, hb int, k1 long, k2 long, at int"
    )
    twice = written(_repeated(windows, "ha", "hb"), "repeated")
    starts = written(_lists(windows.join(twice, ["ha", "hb"], "left_semi")), "windows")

    kind = keyed.schema["row"].dataType.simpleString()
    found = keyed.join(starts, ["k1", "k2"], "left").select("row", "k1", "k2", "text", "places").mapInArrow(
        _removed(window, as_is), f"row {kind}, n_words long, n_removed long, kept_text string"
    )
    return found.select(
        F.col("row.id").alias(id_col),
        *[F.col(f"row.c{k}").alias(c) for k, c in enumerate(keep_columns)],
        "n_words",
        "n_removed",
        "kept_text",
    )


def _repeated(rows: DataFrame, *hashes: str) -> DataFrame:
    """The hashes that occur more than once. Joined as a table of their own: beside an
    aggregate Spark does not split the partition of a hot hash."""
    return rows.groupBy(*hashes).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*hashes)


def _lists(rows: DataFrame) -> DataFrame:
    """The positions of each text; at most one for each of its words."""
    return rows.groupBy("k1", "k2").agg(F.collect_set("at").alias("places"))
