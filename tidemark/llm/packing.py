"""Op 3: vector bin packing of examples into training sequences.

A sequence has three limits at once: tokens, segments (pieces of examples) and loss-bearing
tokens. The next piece of a sequence is the one with the largest dot product of its demands
and what the sequence has left, each dimension weighted by its mean demand: a piece that is
heavy where there is room. The pool is kept in two orders, and of the pieces that fit only the
longest and those with most loss are compared. If none fits, one is cut to fill the rest. A
sequence that no piece can fill is cut back to a power of two, so that none needs padding.

Every task packs the rows it reads, with a pool of a bounded number of pieces: no shuffle, and
one tail of short sequences for each task.
"""

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from math import inf

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.bpe import Ids
from tidemark.llm.shipping import ship
from tidemark.llm.words import text_slices

#: Pieces from which the next one is chosen.
POOL = 1024

_encoders: dict[str, Ids] = {}


#: Pieces that fit and are compared by their dot products, from each of two ends.
COMPARED = 8


class Packer:
    """Takes examples one by one; ``ready`` holds the finished pieces."""

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int, first_sequence: int = 0):
        if min(max_tokens, max_segments, max_loss) < 1 or max_tokens & (max_tokens - 1):
            raise ValueError("limits are at least 1, and max_tokens is a power of two")
        self._tokens, self._segments, self._loss = max_tokens, max_segments, max_loss
        self._sequence = first_sequence
        # The pool in two orders: (tokens, loss, number) and (loss, tokens, number).
        self._by_tokens: list[tuple[int, int, int]] = []
        self._by_loss: list[tuple[int, int, int]] = []
        self._piece: dict[int, tuple] = {}
        self._number = 0
        self._seen_tokens = self._seen_loss = 0
        self.ready: list[tuple] = []

    def add(self, key, ids: bytes, plain: int = 0) -> None:
        """An example of 32-bit ids, the first ``plain`` of which bear no loss."""
        n = len(ids) // 4
        example = (key, ids, n, plain)
        start = 0
        while n - start >= self._tokens and self._of(example, start, self._tokens) <= self._loss:
            self._close([(example, start, self._tokens)])
            start += self._tokens
        if start < n:
            self._put(example, start, n - start)
        while len(self._piece) > POOL:
            self._fill()

    def finish(self) -> None:
        while self._piece:
            self._fill()

    @staticmethod
    def _of(example, start: int, length: int) -> int:
        """Loss-bearing tokens of a piece."""
        return max(0, start + length - max(start, example[3]))

    def _put(self, example, start: int, length: int) -> None:
        loss = self._of(example, start, length)
        self._number += 1
        self._piece[self._number] = (example, start, length)
        insort(self._by_tokens, (length, loss, self._number))
        insort(self._by_loss, (loss, length, self._number))
        self._seen_tokens += length
        self._seen_loss += loss

    def _take(self, tokens: int, loss: int, number: int):
        del self._by_tokens[bisect_left(self._by_tokens, (tokens, loss, number))]
        del self._by_loss[bisect_left(self._by_loss, (loss, tokens, number))]
        return self._piece.pop(number)

    def _best(self, tokens: int, loss: int) -> tuple[int, int, int] | None:
        """The piece that fits with the largest dot product of demand and room, of the longest
        ones and of those that bear most loss. Demands are parts of the limits, weighted by
        their means; every piece is one segment, so that dimension decides nothing here."""
        by_token = self._seen_tokens * tokens / self._tokens**3
        by_loss = self._seen_loss * loss / self._loss**3
        best, most = None, -1.0
        for pool, turned, room in ((self._by_tokens, False, tokens), (self._by_loss, True, loss)):
            found = 0
            for at in range(bisect_right(pool, (room, inf, 0)) - 1, -1, -1):
                t, w, number = (pool[at][1], pool[at][0], pool[at][2]) if turned else pool[at]
                if t <= tokens and w <= loss:
                    score = t * by_token + w * by_loss
                    if score > most:
                        best, most = (t, w, number), score
                    found += 1
                    if found == COMPARED:
                        break
            if best is None:
                break
        return best

    def _fill(self) -> None:
        tokens, segments, loss = self._tokens, self._segments, self._loss
        chosen = []
        while tokens > 0 and segments > 0 and self._piece:
            best = self._best(tokens, loss)
            if best:
                piece = self._take(*best)
            else:
                longest = self._by_tokens[-1]
                example, start, length = self._piece[longest[2]]
                # As many tokens as both limits leave room for.
                head = min(length, tokens, max(example[3] - start, 0) + loss)
                if head == 0:
                    break
                self._take(*longest)
                piece = (example, start, head)
                if head < length:
                    self._put(example, start + head, length - head)
            chosen.append(piece)
            tokens, segments, loss = tokens - piece[2], segments - 1, loss - self._of(*piece)
        used = self._tokens - tokens
        over = used - (1 << (used.bit_length() - 1))
        while over:
            example, start, length = chosen.pop()
            back = min(over, length)
            if back < length:
                chosen.append((example, start, length - back))
            self._put(example, start + length - back, back)
            over -= back
        self._close(chosen)

    def _close(self, pieces) -> None:
        offset = 0
        for segment, (example, start, length) in enumerate(pieces):
            key, ids, n, _ = example
            loss = self._of(example, start, length)
            cut = ids[4 * start : 4 * (start + length)]
            self.ready.append((key, start, length, cut, loss, n, self._sequence, segment, offset))
            offset += length
        self._sequence += 1


def pack_examples(
    examples: DataFrame,
    tokenizer: str,
    max_tokens: int = 2048,
    max_segments: int = 64,
    max_loss: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    checksums: bool = False,
) -> DataFrame:
    """Pieces of all examples, placed in sequences.

    ``id_col, start, length, ids, loss_tokens, doc_tokens, sequence_id, segment, offset``:
    ``ids`` are the piece's token ids (little-endian unsigned 32-bit; with ``checksums`` the
    column is ``ids_crc32`` instead, their CRC-32), ``start`` its place in
    the example, ``offset`` its place in the sequence. An example is the ids of its prompt
    (which bear no loss), of its text, and ``end_id``.

    Null prompts and texts are empty: such an example is its ``end_id`` alone. Null ids and
    repeated rows stay; other columns are not read; an empty table gives no rows. Sequence
    numbers are unique and do not change when a task runs again.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = Ids(tokenizer)
        encode = _encoders[tokenizer].encode
        end = int(end_id).to_bytes(4, "little")
        packer = Packer(max_tokens, max_segments, max_loss, TaskContext.get().partitionId() << 33)
        for batch in batches:
            texts, prompts = batch.column(1).fill_null(""), batch.column(2).fill_null("")
            for start, stop in text_slices(texts):
                rows = [c.slice(start, stop - start).to_pylist() for c in (batch.column(0), texts, prompts)]
                for key, text, prompt in zip(*rows):
                    lead = encode(prompt) if prompt else b""
                    packer.add(key, lead + encode(text) + end, len(lead) // 4)
                yield from table(packer)
        packer.finish()
        yield from table(packer)

    def table(packer: Packer) -> Iterator[pa.RecordBatch]:
        ready, packer.ready = packer.ready, []
        if checksums:
            ready = [(*r[:3], zlib.crc32(r[3]), *r[4:]) for r in ready]
        for k in range(0, len(ready), 4096):
            columns = zip(*ready[k : k + 4096])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, layout)], schema=layout
            )

    ship(examples.sparkSession)
    key_type = examples.schema[id_col].dataType
    rows = examples.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        (F.col(prompt_col) if prompt_col else F.lit(None).cast("string")).alias("prompt"),
    )
    layout = pa.schema(
        [
            ("id", to_arrow_type(key_type)),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids_crc32", pa.int64()) if checksums else ("ids", pa.binary()),
            ("loss_tokens", pa.int64()),
            ("doc_tokens", pa.int64()),
            ("sequence_id", pa.int64()),
            ("segment", pa.int32()),
            ("offset", pa.int64()),
        ]
    )
    packed = rows.mapInArrow(
        pack,
        f"id {key_type.simpleString()}, start long, length long, {'ids_crc32 long' if checksums else 'ids binary'}, loss_tokens long, "
        "doc_tokens long, sequence_id long, segment int, offset long",
    )
    return packed.withColumnRenamed("id", id_col)
