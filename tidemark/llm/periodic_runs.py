"""Op 12: runs of words that repeat with a period, by a dictionary of basic factors.

A basic factor is a stretch of words whose length is a power of two. Equal factors of a text get
equal names: one of twice the length is named by the names of its halves. If a text has period q
over 4q words or more, then for the power of two L with L/2 < q <= L the factors of length L in
there come again after exactly q words and not sooner, so their starts, q apart from successor to
successor, form arithmetic progressions; these, side by side, propose the period. Proposals are
extended as far as words q apart are equal, and each run is kept once.

Factors that a text holds once only are dropped from the dictionary, as all longer ones there
are unique as well; in ordinary prose little is left after two or four words.
"""

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.shipping import ship
from tidemark.llm.words import text_buffers, text_slices, word_bounds

#: A run has so many words at least, and so many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(
    words: np.ndarray, offsets: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, length, period`` of all runs, by start and period. ``words`` are the numbers of
    the words of several texts, ``offsets`` where each text starts (and the last one ends)."""
    n = len(words)
    sizes = np.diff(offsets)
    begin, end = np.repeat(offsets[:-1], sizes), np.repeat(offsets[1:], sizes)
    longest = sizes.max(initial=0) // least_periods
    at, code = np.arange(n), words.astype(np.int64)
    place = np.full(n, -1, dtype=np.int64)
    found = []
    size = 1
    while len(at):
        # Names of the factors, and from each to its next occurrence.
        order = np.argsort(code, kind="stable")
        new = np.ones(len(order), dtype=bool)
        new[1:] = np.diff(code[order]) != 0
        name = np.empty(len(order), dtype=np.int64)
        name[order] = np.cumsum(new) - 1
        here, there = at[order[:-1]], at[order[1:]]
        again = ~new[1:] & (end[here] == end[there])
        step = np.zeros(len(at), dtype=np.int64)
        step[order[:-1][again]] = (there - here)[again]
        found.append(_proposals(at, step, size))
        # What occurs once only is dropped, also where it is the second half of a longer one.
        twice = step > 0
        twice[order[1:][again]] = True
        if size // 2 >= longest:
            break
        at, name = at[twice], name[twice]
        place[at] = np.arange(len(at))
        both = at + 2 * size <= end[at]
        second = np.full(len(at), -1, dtype=np.int64)
        second[both] = place[at[both] + size]
        place[at] = -1
        both = second >= 0
        code = name[both] * (name.max(initial=0) + 1) + name[second[both]]
        at = at[both]
        size *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = (np.concatenate(part) for part in zip(*found))
    enough = length >= np.maximum(least_words, least_periods * period)
    start, length, period = _extended(words, begin, end, start[enough], length[enough], period[enough])
    runs = np.unique(np.stack([start, period, length], axis=1), axis=0)
    return runs[:, 0], runs[:, 2], runs[:, 1]


def _proposals(at: np.ndarray, step: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, length, period`` from neighbouring factors that come again after as many words:
    more than half their length, as others are found with shorter factors, and no more than it."""
    near = np.flatnonzero((step > size // 2) & (step <= size))
    if len(near) == 0:
        return (np.zeros(0, np.int64),) * 3
    at, step = at[near], step[near]
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(step) != 0))
    first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(at) - 1]])
    return at[first], at[last] - at[first] + size + step[first], step[first]


def _extended(words, begin, end, start, length, period) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same runs, none of which a neighbouring word can extend."""
    start, stop = start.copy(), start + length
    going = np.arange(len(start))
    while len(going):
        s = start[going]
        going = going[s > begin[s]]
        same = words[start[going] - 1] == words[start[going] - 1 + period[going]]
        going = going[same]
        start[going] -= 1
    going = np.arange(len(start))
    while len(going):
        going = going[stop[going] < end[start[going]]]
        same = words[stop[going]] == words[stop[going] - period[going]]
        going = going[same]
        stop[going] += 1
    return start, stop - start, period


def _numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for every word, equal for equal words only."""
    if len(starts) == 0:
        return np.zeros(0, np.int64)
    compact, sizes = _joined(data, starts, ends, np.zeros(len(starts), dtype=bool))
    column = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(_before(sizes)), pa.py_buffer(compact)]
    )
    return column.dictionary_encode().indices.to_numpy()


def _before(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words, a space after those that are ``spaced`` (and not the last of their
    text), and the size of each with it."""
    low, high = int(starts[0]), int(ends[-1])
    edge = np.zeros(high - low + 1, dtype=np.int8)
    edge[starts - low] += 1
    edge[ends - low] -= 1
    inside = np.cumsum(edge, dtype=np.int8).astype(bool)
    raw = data[low : high + 1].copy()
    after = ends[spaced] - low
    inside[after] = True
    raw[after] = 0x20
    return raw[inside[: len(raw)]], ends - starts + spaced


def _work(least_words: int, least_periods: int, layout: pa.Schema):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, texts = text_buffers(batch.column(1))
            for low, high in text_slices(batch.column(1)):
                starts, ends, offsets = word_bounds(data, texts[low : high + 1])
                words = _numbered(data, starts, ends)
                runs = find_runs(words, offsets, least_words, least_periods)
                kept = _kept(len(words), *runs)
                text = np.searchsorted(offsets, runs[0], side="right") - 1
                columns = [
                    batch.column(0).slice(low, high - low),
                    pa.array(np.diff(offsets).astype(np.int64)),
                    _run_lists(high - low, text, runs[0] - offsets[text], runs[1], runs[2]),
                    pa.array(_longest(high - low, text, runs[0] - offsets[text], runs[1], runs[2]), _RUN),
                    _texts(data, starts, ends, offsets, kept),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=layout)

    return work


def _kept(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which words no run holds after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) == 0


def _run_lists(n: int, text: np.ndarray, *columns: np.ndarray) -> pa.Array:
    ends = np.searchsorted(text, np.arange(n + 1), side="left").astype(np.int32)
    rows = pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], fields=list(_RUN))
    return pa.ListArray.from_arrays(pa.array(ends), rows)


def _longest(n: int, text, start, length, period) -> list[dict | None]:
    """For each text the run of the greatest exact exponent; of equal ones the first."""
    best: list = [None] * n
    for k, s, m, p in zip(text.tolist(), start.tolist(), length.tolist(), period.tolist()):
        if best[k] is None or Fraction(m, p) > Fraction(best[k]["length"], best[k]["period"]):
            best[k] = {"start": s, "length": m, "period": p}
    return best


def _texts(data, starts, ends, offsets, kept) -> pa.Array:
    """The kept words of each text, joined by one space."""
    n = len(offsets) - 1
    before = np.concatenate([[0], np.cumsum(kept)])[offsets]
    if before[-1] == 0:
        return pa.array([""] * n, pa.string())
    last = np.zeros(before[-1], dtype=bool)
    last[before[1:][before[1:] > before[:-1]] - 1] = True
    raw, sizes = _joined(data, starts[kept], ends[kept], ~last)
    bounds = _before(sizes)[before]
    large = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
    return large.cast(pa.string())


def periodic_runs(
    docs: DataFrame,
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, n_words, runs, top, kept_text`` for every row of ``docs``.

    A word is a longest run of characters other than ASCII white space. ``runs`` lists every
    ``start, length, period`` (in words, from 0) of a stretch whose smallest period is ``period``,
    that is at least ``least_words`` and ``least_periods`` periods long and that no neighbouring
    word extends, by start, then period. ``top`` is the one with the greatest exact ratio of
    length to period (the first of equal ones), null without runs. ``kept_text`` is the text
    without the words that any run holds after its first period, joined by one space.

    Null and empty texts have no words and no runs. Null ids and repeated rows stay; other columns
    are not read; an empty table gives no rows. Words are compared whole, not by hashes. A text is
    worked on where it is read, in memory in proportion to it; there is no shuffle.
    """
    if least_periods < 4:
        raise ValueError("runs of fewer than 4 periods are not all proposed")
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    run = "struct<start: long, length: long, period: long>"
    layout = pa.schema(
        [("id", to_arrow_type(kind)), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("top", _RUN), ("kept_text", pa.string())]
    )
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = rows.mapInArrow(
        _work(least_words, least_periods, layout),
        f"id {kind.simpleString()}, n_words long, runs array<{run}>, top {run}, kept_text string",
    )
    return found.withColumnRenamed("id", id_col)
