"""Words and word hashes of whole Arrow batches, without a Python loop over words."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The bytes that separate words, ``[\x20\x09-\x0D]``.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Texts are handled in slices of about so many bytes (at least one text each), so that the
#: arrays beside them stay small whatever the size of a batch.
SLICE_BYTES = 1 << 20


def text_slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``SLICE_BYTES`` of text."""
    if len(column) == 0:
        return
    offsets = text_buffers(column)[1]
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield start, stop
        start = stop


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its texts; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, ends


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word in ``data[offsets[0]:offsets[-1]]``, and for every text
    the number of words before it (one entry more than there are texts).

    A word is a longest run of bytes that are not separators; texts do not touch.
    """
    low, high = int(offsets[0]), int(offsets[-1])
    solid = ~_SPACE[data[low:high]]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = offsets[1:-1] - low
    edge = inner[(inner > 0) & (inner < high - low)]
    first[edge] |= solid[edge]
    last[edge - 1] |= solid[edge - 1]
    starts = np.flatnonzero(first) + low
    ends = np.flatnonzero(last) + low + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, base, dtype=np.uint64)
        if n:
            out[0] = 1
        return np.multiply.accumulate(out)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int
) -> np.ndarray:
    """A 64-bit hash of every word: its bytes as a polynomial in the odd ``base``, mixed.

    All words at once: differences of one running sum, divided by the power at the word's
    start (an odd number has an inverse modulo 2^64).
    """
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    low, high = int(starts[0]), int(ends[-1])
    up = _powers(base, high - low)
    total = np.zeros(high - low + 1, dtype=np.uint64)
    np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    down = _powers(pow(base, -1, 1 << 64), high - low)
    return mix((total[ends - low] - total[starts - low]) * down[starts - low])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the word (multiply and shift)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def join_hashes(left: np.ndarray, right: np.ndarray, gap: int) -> np.ndarray:
    """Hash at ``i`` of the run that is ``left[i]`` followed by ``right[i + gap]``.

    With ``gap`` the length of the left run, this doubles the length of all windows at once.
    """
    n = max(len(right) - gap, 0)
    return mix(left[:n] * np.uint64(0x9E3779B97F4A7C15) + right[gap : gap + n])


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive words, by doubling."""
    if length < 1 or len(words) < length:
        return np.zeros(0, dtype=np.uint64)
    runs, have = words, 1
    for bit in bin(length)[3:]:
        runs = join_hashes(runs, runs, have)
        have *= 2
        if bit == "1":
            runs = join_hashes(runs, words, have)
            have += 1
    return runs
