"""Op 13: secrets in texts, and weak candidates that belong to a credential.

A credential has parts: an identifier that says who, a secret, an endpoint it is for. Some parts
show by themselves (*strong*): assignments of long values, access keys, long hexadecimal numbers.
Others are everyday text unless the rest of a credential stands near: a short password, a user
name, a host. Such a *weak* candidate is reported only where complementary parts lie in its scope,
the block of text around it that no blank line breaks, up to ``reach`` characters on both sides.

Texts are read once, where they are, for the parts; what is linked is an interval join on
the parts alone. A part lies in one bin of the text, a scope in a few: they meet by text and bin,
so a long text full of parts is dealt over many tasks, and within a bin there is room for few.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.shipping import ship
from tidemark.llm.storage import written
from tidemark.llm.words import text_slices

#: The strong kinds, in the order in which spans of one start are listed. Matches
#: do not overlap those of their kind, and what is too short is dropped (see ``_strong``).
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")
LEAST_VALUE = 12

#: Weak identifiers and secrets: named values.
NAMED_ID = re.compile(
    rb"""(?i:\b(?:user|user_?name|login|account|account_?id|client_?id|key_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,})"""
)
NAMED_SECRET = re.compile(
    rb"""(?i:\b(?:pass|pwd|pin|passphrase|passcode|auth|credentials?|private_?key|signature)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=!@#$%^&*-]{4,})"""
)
#: A mail address, as a login.
MAIL = re.compile(rb"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A long word of mixed characters.
MIXED = re.compile(rb"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Endpoints: an address, a host with a port, a machine's number.
URL = re.compile(rb"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>]+""")
HOST = re.compile(rb"(?<![A-Za-z0-9.@-])[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+:[0-9]{2,5}(?![0-9])")
MACHINE = re.compile(rb"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])")

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
_ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "secret": "secret", "endpoint": "endpoint"}

#: Characters on both sides of a candidate that its scope takes in.
REACH = 256

_BLANK = re.compile(rb"\n[ \t\r\f\v]*\n")

_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_PART = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
_SPAN_SQL = "struct<kind: string, start: long, end: long>"
_PART_SQL = "struct<kind: string, start: long, end: long, low: long, high: long>"


def _strong(text: bytes) -> list[tuple[str, int, int]]:
    """The strong spans of a text, in bytes."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return found


def _mixed(word: bytes) -> bool:
    """Upper-case letters, lower-case letters and digits, as in no word of a language."""
    return all(any(low <= b <= high for b in word) for low, high in (b"AZ", b"az", b"09"))


def _weak(text: bytes, strong: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak candidates that lie beside the strong spans and beside each other, in bytes."""
    short = [m.span() for m in ASSIGN.finditer(text) if 4 <= m.end(2) - m.start(2) < LEAST_VALUE]
    found = [("secret", *s) for s in short]
    found += [("identifier", *m.span()) for m in NAMED_ID.finditer(text)]
    found += [("secret", *m.span()) for m in NAMED_SECRET.finditer(text)]
    if b"@" in text:
        found += [("identifier", *m.span()) for m in MAIL.finditer(text)]
    if b"://" in text:
        found += [("endpoint", *m.span()) for m in URL.finditer(text)]
    found += [("endpoint", *m.span()) for pattern in (HOST, MACHINE) for m in pattern.finditer(text)]
    found += [("secret", *m.span()) for m in MIXED.finditer(text) if _mixed(m.group())]
    taken = sorted((s, e) for _, s, e in strong)
    kept, at, last = [], 0, 0
    # By start, longer ones first: one that overlaps a strong span or an earlier one goes.
    for kind, start, end in sorted(found, key=lambda f: (f[1], -f[2], KINDS.index(f[0]))):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if start >= last and (at == len(taken) or taken[at][0] >= end):
            kept.append((kind, start, end))
            last = end
    return kept


def _in_characters(text: bytes) -> np.ndarray:
    """The number of characters before each byte, and in all."""
    first = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(first)])


def _parts_of(text: str, reach: int) -> tuple[list[dict], list[dict]]:
    """Strong spans, and all parts with their scopes where a weak one may be linked."""
    raw = text.encode()
    strong = _strong(raw)
    weak = _weak(raw, strong)
    parts: list[dict] = []
    if not strong and not weak:
        return [], []
    chars = _in_characters(raw)
    # A number without letters may be anything: it is a span, but no part of a credential.
    able = weak + [s for s in strong if not raw[s[1] : s[2]].isdigit()]
    if weak and len({_ROLE[kind] for kind, _, _ in able}) > 1:
        breaks = [m.start() for m in _BLANK.finditer(raw)]
        for kind, start, end in able:
            k = np.searchsorted(breaks, start)
            low = chars[breaks[k - 1]] if k else 0
            high = chars[breaks[k]] if k < len(breaks) else chars[-1]
            s, e = int(chars[start]), int(chars[end])
            parts.append(
                {"kind": kind, "start": s, "end": e, "low": max(int(low), s - reach), "high": min(int(high), e + reach)}
            )
    spans = [{"kind": kind, "start": int(chars[s]), "end": int(chars[e])} for kind, s, e in strong]
    return sorted(spans, key=lambda s: (s["start"], KINDS.index(s["kind"]))), parts


def _scan(reach: int, layout: pa.Schema):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in text_slices(batch.column(3)):
                part = batch.slice(low, high - low)
                found = [_parts_of(t.as_py(), reach) for t in part.column(3)]
                lists = [pa.array([f[k] for f in found], pa.list_(kind)) for k, kind in ((0, _SPAN), (1, _PART))]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *lists], schema=layout)

    return scan


def _linked(found: DataFrame, bin_size: int) -> DataFrame:
    """``t1, t2, more``: the weak candidates of each text that are to be reported."""
    parts = (
        found.where(F.size("parts") > 0)
        .dropDuplicates(["t1", "t2"])
        .select("t1", "t2", F.explode("parts").alias("p"))
        .select("t1", "t2", "p.*")
        .withColumn("role", _role())
        .withColumn("strong", F.col("kind").isin("assign", "access", "hex"))
    )
    bins = lambda at: F.floor(F.col(at) / bin_size)
    weak = parts.where(~F.col("strong")).select(
        "t1", "t2", "kind", "role", "start", "end", "low", "high",
        F.explode(F.sequence(bins("low"), bins("high"))).alias("bin"),
    )
    others = parts.select(
        F.col("t1").alias("o1"), F.col("t2").alias("o2"), F.col("role").alias("other"), F.col("strong").alias("sure"),
        F.col("start").alias("at"), F.col("end").alias("to"), bins("start").alias("o_bin"),
    )
    near = (
        (F.col("t1") == F.col("o1")) & (F.col("t2") == F.col("o2")) & (F.col("bin") == F.col("o_bin"))
        & (F.col("at") >= F.col("low")) & (F.col("to") <= F.col("high")) & (F.col("role") != F.col("other"))
    )
    has = lambda name, condition: F.max(F.when(F.expr(condition), 1).otherwise(0)).alias(name)
    seen = weak.join(others, near).groupBy("t1", "t2", "kind", "role", "start", "end").agg(
        has("sure_id", "other = 'identifier' and sure"), has("id", "other = 'identifier'"),
        has("sure_secret", "other = 'secret' and sure"), has("secret", "other = 'secret'"),
        has("endpoint", "other = 'endpoint'"),
    )
    complete = (
        F.when(F.col("role") == "secret", (F.col("sure_id") == 1) | (F.col("id") + F.col("endpoint") == 2))
        .when(F.col("role") == "identifier", (F.col("sure_secret") == 1) | (F.col("secret") + F.col("endpoint") == 2))
        .otherwise(F.col("id") + F.col("secret") == 2)
    )
    return seen.where(complete).groupBy("t1", "t2").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))


def _role() -> Column:
    role = F.lit("endpoint")
    for kind in KINDS[:-1]:
        role = F.when(F.col("kind") == kind, _ROLE[kind]).otherwise(role)
    return role


def secret_spans(
    docs: DataFrame, reach: int = REACH, id_col: str = "doc_id", text_col: str = "text", bin_size: int = 1024
) -> DataFrame:
    """``id_col, base, spans`` for every row of ``docs``: lists of ``kind, start, end`` in
    characters from 0, the end exclusive, by start and then in the order of ``KINDS``.

    ``base`` holds the strong spans: ``assign`` (a named value of 12 characters or more),
    ``access`` (an access key) and ``hex`` (16 hexadecimal digits or more). ``spans`` holds them
    all and the weak ones with complementary parts in their scope: an ``identifier`` with a
    strong secret, or with a weak one and an endpoint; a ``secret`` with an access key, or with
    a weak identifier and an endpoint; an ``endpoint`` with an identifier and a secret, weak or
    strong. A weak candidate that overlaps a strong span, or one that starts before it, is none;
    a ``hex`` span of digits alone (a card, an amount) is no part of a credential.

    Null and empty texts have no spans; null ids and repeated rows stay; other columns are not
    read; an empty table gives no rows. Texts are told apart by 128 bits of hashes; each different
    one is linked once, however many copies there are.
    """
    if reach < 0 or bin_size < 1:
        raise ValueError("reach is 0 or more and bin_size 1 or more")
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text")
    )
    layout = pa.schema(
        [("id", to_arrow_type(kind)), ("t1", pa.int64()), ("t2", pa.int64()), ("base", pa.list_(_SPAN)), ("parts", pa.list_(_PART))]
    )
    scanned = rows.mapInArrow(
        _scan(reach, layout),
        f"id {kind.simpleString()}, t1 long, t2 long, base array<{_SPAN_SQL}>, parts array<{_PART_SQL}>",
    )
    found = written(scanned, "parts")
    # A table of its own: beside an aggregate Spark does not split the partition of a text that
    # many rows share.
    more = written(_linked(found, bin_size), "linked").withColumnsRenamed({"t1": "m1", "t2": "m2"})
    place = {kind: k for k, kind in enumerate(KINDS)}
    order = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])

    def by_start(spans: Column) -> Column:
        keyed = F.transform(spans, lambda s: F.struct(s["start"], order[s["kind"]].alias("k"), s["kind"], s["end"]))
        return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"], s["start"], s["end"]))

    joined = found.join(more, (F.col("t1") == F.col("m1")) & (F.col("t2") == F.col("m2")), "left")
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(by_start(F.concat("base", "more")))
    return joined.select(F.col("id").alias(id_col), "base", spans.alias("spans"))
