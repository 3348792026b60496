"""Token ids, and token counts of every prefix, for the tokenizer ``word_bpe_49k.json``.

That tokenizer drops white space and never merges across it, so a text is the sequence of its
chunks between white space, and equal chunks have equal tokens. Both classes keep what they
have found for a chunk in a cache of bounded size, one for each Python worker.
"""

import json
import os
import re
import unicodedata
from array import array
from itertools import accumulate

import ahocorasick
import numpy as np

# One task, one core: set before the library starts its threads.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
os.environ.setdefault("RAYON_NUM_THREADS", "1")

import regex
from tokenizers import Tokenizer

from tidemark.llm.recent import Recent

#: Unicode white space; it differs from ``str.split`` by U+001C to U+001F.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0                　"
_CHUNK = re.compile(f"[^{_SPACES}]+")
_CHUNK_AND_SPACE = re.compile(f"[^{_SPACES}]+[{_SPACES}]*|[{_SPACES}]+")
_ODD = re.compile("[\x1c-\x1f]")

#: Characters for which lower case, normal form and character class are beyond doubt.
_PLAIN = re.compile("[!-~¡§«°·»¿À-ÖØ-öø-ÿ]*")

#: The tokenizer's own pattern and its special strings.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: The same for lower-case plain text.
_PLAIN_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
_SPECIAL = re.compile(r"<\|startoftext\|>|<\|endoftext\|>")
_END = "</w>"

#: Chunks whose ids are kept (twice as many at most, of some 200 bytes): words with and without
#: the marks behind them, so more than there are pieces.
_CHUNKS = 500_000


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


_BYTE = _byte_characters()


def chunks_of(text: str) -> list[str]:
    return _CHUNK.findall(text) if _ODD.search(text) else text.split()


class Ids:
    """Ids of whole texts, as little-endian unsigned 32-bit values."""

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._piece = Recent(self._of_piece)
        self._chunk = Recent(self._of_chunk, _CHUNKS)

    def _of_piece(self, piece: str) -> bytes:
        units = piece if piece.isascii() else "".join([_BYTE[b] for b in piece.encode()])
        return array("I", [t.id for t in self._model.tokenize(units)]).tobytes()

    def _of_chunk(self, chunk: str) -> bytes:
        if _PLAIN.fullmatch(chunk) and "<|" not in chunk:
            return b"".join(map(self._piece.__getitem__, _PLAIN_PIECE.findall(chunk.lower())))
        ids = self._tokenizer.encode(chunk, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self._chunk.__getitem__, chunks_of(text)))


class PrefixCounts:
    """Exact token counts of every prefix of a text, by dynamic programming.

    Merging never crosses from one token into the next, so if a run of bytes ends in token
    ``t``, what is before ``t`` is encoded as it would be alone. For each end the table holds
    the last token of the run up to there and the number of tokens; an end is derived from an
    earlier one by the one token that fits behind its last token. The last piece of a prefix
    ends a word, which has tokens of its own (``</w>``): a second column of the table.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self._rank, self._parts = {}, {}
        for k, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self._rank[left, right] = k
            self._parts.setdefault(left + right, (left, right))
        self._tokens = [t for t in model["vocab"] if not _SPECIAL.fullmatch(t)]
        opened, closed = {}, {}
        for k, token in enumerate(self._tokens):
            if token.endswith(_END):
                closed[token[: -len(_END)]] = k
            else:
                opened[token] = k
        self._find = ahocorasick.Automaton()
        for text in opened.keys() | closed.keys():
            self._find.add_word(text, (len(text), opened.get(text, -1), closed.get(text, -1)))
        self._find.make_automaton()
        self._fits = Recent(self._compare)
        self._piece = Recent(self._steps)
        self._chunk = Recent(self._of_chunk)

    def _spine(self, token: str, side: int) -> list[tuple[str, float]]:
        """The parts of a token at its left (0) or right (1) edge, from the smallest on, each
        with the rank of the merge that takes it into the next."""
        out, until = [], float("inf")
        while token:
            out.append((token, until))
            parts = self._parts.get(token)
            until = self._rank[parts] if parts else 0
            token = parts[side] if parts else ""
        return out[::-1]

    def _compare(self, pair: int) -> bool:
        """Whether two tokens side by side stay two: no merge across their border comes before
        those that complete them. Merges of one rank are made from left to right."""
        left = self._spine(self._tokens[(pair >> 20) - 1], 1)
        right = self._spine(self._tokens[pair & 0xFFFFF], 0)
        i = j = 0
        while True:
            (a, until_a), (b, until_b) = left[i], right[j]
            across = self._rank.get((a, b))
            if across is not None and across < until_a and across <= until_b:
                return False
            if until_a == until_b == float("inf"):
                return True
            if until_a <= until_b:
                i += 1
            else:
                j += 1

    def _of_piece(self, piece: str) -> list[int]:
        """Token counts after every character of a piece, each prefix being a whole word."""
        if piece.isascii() and piece.isprintable():
            units, ends = piece, None
        else:
            units, ends = "", []
            for character in piece:
                units += "".join([_BYTE[b] for b in character.encode()])
                ends.append(len(units) - 1)
        n = len(units)
        # ``last`` holds token numbers plus one, so that 0 is the empty run.
        last, count, whole, fits = [0] * (n + 1), [0] * (n + 1), [0] * n, self._fits
        for end, (length, opened, closed) in self._find.iter(units):
            start = end + 1 - length
            before = last[start]
            if start and not before:
                continue
            if opened >= 0 and not last[end + 1] and (not start or fits[before << 20 | opened]):
                last[end + 1] = opened + 1
                count[end + 1] = count[start] + 1
            if closed >= 0 and not whole[end] and (not start or fits[before << 20 | closed]):
                whole[end] = count[start] + 1
        found = whole if ends is None else [whole[e] for e in ends]
        if not all(found):
            raise ValueError(f"the vocabulary has no tokens for {piece!r}")
        return found

    def _steps(self, piece: str) -> bytes:
        """By how much each character of a piece changes the count."""
        counts = self._of_piece(piece)
        if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():
            # Cut short, a contraction is an apostrophe and letters.
            mark = self._of_piece("'")[0]
            counts = [mark, *(mark + n for n in self._of_piece(piece[1:])[:-1]), counts[-1]]
        return array("i", map(int.__sub__, counts, [0, *counts])).tobytes()

    def _ordinary(self, chunk: str) -> list[int]:
        """Counts after every character of a normalised, lower-case chunk."""
        steps = array("i", b"".join(map(self._piece.__getitem__, _PIECE.findall(chunk))))
        return list(accumulate(steps))

    def _normalised(self, part: str) -> list[int]:
        """Counts after every character of a part without special strings."""
        if _PLAIN.fullmatch(part):
            return self._ordinary(part.lower())
        # A run begins with a character that composes with nothing before it, so runs are
        # normalised one by one; a prefix that ends within one is counted on its own.
        runs: list[str] = []
        for c in part:
            if runs and _composes(c):
                runs[-1] += c
            else:
                runs.append(c)
        texts = [_fold(run) for run in runs]
        whole = self._ordinary("".join(texts))
        out, done = [], 0
        for run, text in zip(runs, texts):
            for cut in range(1, len(run)):
                head = "".join(texts)[:done] + _fold(run[:cut])
                out.append(self._ordinary(head)[-1])
            done += len(text)
            out.append(whole[done - 1])
        return out

    def counts(self, chunk: str) -> list[int]:
        """Counts after every character of a chunk without white space."""
        if "<|" not in chunk:
            return self._normalised(chunk)
        out, before, start = [], 0, 0
        while start < len(chunk):
            special = _SPECIAL.search(chunk, start)
            stop = special.end() if special else len(chunk)
            part = [before + n for n in self._normalised(chunk[start:stop])]
            if special:
                # A special string is one token once it is whole, and parts what is around it.
                lead = special.start() - start
                part[-1] = (part[lead - 1] if lead else before) + 1
            out.extend(part)
            before, start = out[-1], stop
        return out

    def _of_chunk(self, chunk: str) -> bytes:
        """The steps of a chunk and of the white space behind it, which has none."""
        text = chunk.rstrip(_SPACES)
        if _PLAIN.fullmatch(text) and "<|" not in text:
            steps = b"".join(map(self._piece.__getitem__, _PLAIN_PIECE.findall(text.lower())))
        else:
            counts = self.counts(text)
            steps = array("i", map(int.__sub__, counts, [0, *counts])).tobytes()
        return steps + bytes(4 * (len(chunk) - len(text)))

    def encode(self, text: str) -> np.ndarray:
        """Entry ``k`` is the number of tokens of ``text[: k + 1]``."""
        steps = b"".join(map(self._chunk.__getitem__, _CHUNK_AND_SPACE.findall(text)))
        return np.cumsum(np.frombuffer(steps, dtype="<i4"), dtype=np.int32)


def _fold(text: str) -> str:
    """Normal form C, then lower case character by character (no rule for word ends)."""
    return "".join(map(str.lower, unicodedata.normalize("NFC", text)))


def _composes(c: str) -> bool:
    """Whether a character may join the one before it in normal form C: marks, and the
    vowels and finals of Hangul (fixed ranges)."""
    return (
        unicodedata.combining(c) != 0
        or unicodedata.category(c)[0] == "M"
        or "\u1161" <= c <= "\u1175"
        or "\u11a8" <= c <= "\u11c2"
    )
