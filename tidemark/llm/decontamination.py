"""Op 9: benchmark passages in training texts, by winnowing.

A window of ``span`` words holds ``span - gram + 1`` word ``gram``-grams; the smallest of their
hashes marks it. Neighbouring windows mostly share their mark, so a text has one fingerprint for
each change of it, with the range of windows it stands for. Equal windows have equal marks, so
joining the fingerprints of both sides misses no shared span of ``span`` words or more. Each hit
is then extended: the whole windows of its range are compared, and the words of all equal ones
are hit.

DataFrame functions only; the main path runs in the JVM. The texts are cut into words once. What
an array of hashes goes through is done by doubling, a few passes over the whole array, because
a function of slices would copy them for every word.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import written

SPAN = 13
GRAM = 6

#: Bitmaps of so many bits say which marks a benchmark cannot have, and which texts share none
#: with it. They are of one size whatever the tables', and only spare the joins work: a full one
#: lets everything through.
BITS = 1 << 20
TEXT_BITS = 1 << 22

#: The characters between words (after lower-casing ASCII letters).
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for texts as they are.
_BETWEEN_RAW = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def words_of(text: Column) -> Column:
    """The words of a text; null has none."""
    return F.array_remove(F.split(_lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def _word_hashes(text: Column) -> Column:
    """The hash of each word. Words of ASCII letters are lower-cased at once, only others
    letter by letter."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN_RAW), "")
    plain = lambda w: F.octet_length(w) == F.char_length(w)
    return F.transform(words, lambda w: F.xxhash64(F.when(plain(w), F.lower(w)).otherwise(_lower(w))))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, not once for each use within a lambda."""
    return F.transform(F.array(value), body).getItem(0)


def _beside(left: Column, right: Column, gap: int, join) -> Column:
    """``join(left[i], right[i + gap])`` for every ``i`` that has both."""
    n = F.greatest(F.least(F.size(left), F.size(right) - gap), F.lit(0))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, gap + 1, n), join)


def _both(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _grams(words: Column, length: int) -> Column:
    """The hash of every ``length`` consecutive words, by doubling."""

    def longer(runs: Column, have: int, bits: str) -> Column:
        if not bits:
            return runs
        double = _beside(runs, runs, have, _both)
        if bits[0] == "0":
            return _let(double, lambda r: longer(r, 2 * have, bits[1:]))
        return _let(double, lambda r: _let(_beside(r, words, 2 * have, _both), lambda s: longer(s, 2 * have + 1, bits[1:])))

    return longer(words, 1, bin(length)[3:])


def _smallest(values: Column, width: int) -> Column:
    """The least of every ``width`` consecutive values, by doubling."""

    def wider(least: Column, have: int) -> Column:
        if have == width:
            return least
        gap = min(have, width - have)
        return _let(_beside(least, least, gap, lambda a, b: F.least(a, b)), lambda v: wider(v, have + gap))

    return wider(values, 1)


_MARKS = "array<struct<mark: bigint, low: int, high: int, length: int>>"


def _fingerprints(hashes: Column, span: int, gram: int) -> Column:
    """``mark, low, high, length`` for each change of the mark: windows ``low`` to ``high`` of
    ``length`` words have it. None for texts shorter than a window."""

    def thinned(marks: Column) -> Column:
        changes = F.filter(
            F.sequence(F.lit(0), F.size(marks) - 1),
            lambda i: (i == 0) | (F.get(marks, i) != F.get(marks, i - 1)),
        )
        return _let(
            changes,
            lambda c: F.transform(
                c,
                lambda at, k: F.struct(
                    F.get(marks, at).alias("mark"),
                    at.alias("low"),
                    (F.coalesce(F.get(c, k + 1), F.size(marks)) - 1).alias("high"),
                    F.lit(span).alias("length"),
                ),
            ),
        )

    found = _let(
        _grams(hashes, gram), lambda g: _let(_smallest(g, span - gram + 1), thinned)
    )
    return F.when(F.size(hashes) >= span, found).otherwise(F.array().cast(_MARKS))


def _short_marks(hashes: Column, length: int) -> Column:
    """The same for every run of ``length`` words; items shorter than a window are looked up by
    the longest run of a power of two words at their start."""
    runs = F.transform(
        _grams(hashes, length),
        lambda h, i: F.struct(
            F.xxhash64(h, F.lit(length)).alias("mark"), i.alias("low"), i.alias("high"), F.lit(length).alias("length")
        ),
    )
    return F.when(F.size(hashes) >= length, runs).otherwise(F.array().cast(_MARKS))


def _same(words: Column, at: Column, length: Column) -> list[Column]:
    """Two independent hashes of the words from ``at`` (0 is the first) on."""
    window = F.slice(words, at + 1, length)
    return [F.xxhash64(window).alias("_ha"), F.xxhash64(F.lit(1), window).alias("_hb")]


def _maybe(df: DataFrame, name: str, held: DataFrame, bits: int) -> DataFrame:
    """The rows of ``df`` whose number ``name`` may be one of those in ``held``: all that are, and
    of the others those that share a bit with one. The bitmap is an array of ``bits / 64``
    numbers that every task gets, whatever the size of ``held``."""
    at = F.col(name).bitwiseAND(bits - 1)
    word, place = F.shiftright(at, 6), at.bitwiseAND(63).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place).alias("bit")
    words = held.select(word.alias("id"), bit).groupBy("id").agg(F.bit_or("bit").alias("bit"))
    every = held.sparkSession.range(bits // 64).join(words, "id", "left").select("id", F.coalesce("bit", F.lit(0)).alias("bit"))
    whole = every.agg(F.array_sort(F.collect_list(F.struct("id", "bit"))).alias("all"))
    bitmap = whole.select(F.transform("all", lambda x: x["bit"])).scalar()
    set_there = F.call_function("shiftright", F.get(bitmap, word.cast("int")), place).bitwiseAND(1) == 1
    return df.where(F.col(name).isNull() | set_there)


def _keys(id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.xxhash64(id_col, text, F.lit(1)).alias("_k1"), F.xxhash64(text).alias("_k2")]


def _counted(
    docs: DataFrame,
    benchmark: DataFrame,
    span: int,
    gram: int,
    id_col: str,
    text_col: str,
    item_col: str,
    item_text_col: str,
) -> tuple[DataFrame, DataFrame]:
    """``_id, _k1, _k2, n_words`` of every row, and ``_k1, _k2, n_hit, items, contaminated`` of
    each text with hits."""
    if not 1 <= gram <= span:
        raise ValueError("grams are no longer than windows")
    items = written(
        benchmark.select(F.col(item_col).cast("string").alias("item"), words_of(F.col(item_text_col)).alias("words"))
        .where(F.size("words") > 0)
        .withColumn("n", F.least(F.size("words"), F.lit(span)))
        .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))),
        "items",
    )
    # Items shorter than a window are windows of their own length; few lengths, all in one pass.
    lengths = sorted(r.n for r in items.select("n").distinct().where(F.col("n") < span).collect())
    powers = sorted({1 << (n.bit_length() - 1) for n in lengths})
    lead = F.lit(0)
    for p in powers:
        lead = F.when(F.col("n") >= p, p).otherwise(lead)
    hashes = F.col("hashes")

    def fingerprints(of: Column) -> Column:
        return reduce(F.concat, [_fingerprints(of, span, gram), *[_short_marks(of, p) for p in powers]])

    # Every window of the items, and the marks by which its text is found.
    windows = written(
        items.select("item", "n", "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("n"))).alias("at"))
        .select(F.col("n").alias("length"), *_same(F.col("words"), F.col("at"), F.col("n")), "item")
        .distinct(),
        "windows",
    )
    whole = items.where(F.col("n") == span).select(F.explode(_fingerprints(hashes, span, gram)).alias("f")).select("f.mark")
    if powers:
        short = items.where(F.col("n") < span).withColumn("lead", lead)
        for p in powers:
            first = short.where(F.col("lead") == p).select(F.get(_short_marks(hashes, p), F.lit(0))["mark"].alias("mark"))
            whole = whole.unionByName(first)
    marks = written(whole.distinct(), "marks")

    # One pass over the texts: a row for each, and one for each fingerprint a benchmark may have.
    none = F.array(F.struct(F.lit(None).cast("long").alias("mark"), *[F.lit(-1).alias(c) for c in ("low", "high", "length")]))
    # A column of its own would be computed once for each use.
    found = docs.select(F.col(id_col).alias("_id"), *_keys(id_col, text_col), F.array(_word_hashes(F.col(text_col))).alias("hashes"))
    looked = F.transform(
        "hashes", lambda h: F.struct(F.size(h).cast("long").alias("n_words"), F.concat(none, fingerprints(h)).alias("marks"))
    )
    found = found.select("_id", "_k1", "_k2", F.explode(looked).alias("x"))
    found = found.select("_id", "_k1", "_k2", "x.n_words", F.explode("x.marks").alias("f")).select("_id", "_k1", "_k2", "n_words", "f.*")
    found = written(_maybe(found, "mark", marks, BITS), "marked")
    rows = found.where(F.col("mark").isNull()).select("_id", "_k1", "_k2", "n_words")

    # Texts that share a mark with an item, with the ranges of their windows.
    shared = found.join(marks, "mark", "left_semi").select("_k1", "_k2", F.struct("low", "high", "length").alias("range"))
    ranges = written(shared.groupBy("_k1", "_k2").agg(F.collect_set("range").alias("ranges")), "ranges")
    ranges = ranges.withColumnsRenamed({"_k1": "r1", "_k2": "r2"})
    # They are few among all texts: the others should not take part in a join.
    again = docs.select(*_keys(id_col, text_col), F.col(text_col).alias("text"))
    again = _maybe(again, "_k2", ranges.select(F.col("r2").alias("_k2")), TEXT_BITS)
    texts = again.join(ranges, (F.col("_k1") == F.col("r1")) & (F.col("_k2") == F.col("r2")))
    of_length = F.when(F.col("r.length") == span, F.array(F.lit(span)))
    for p in powers:
        of_length = of_length.when(F.col("r.length") == p, F.array(*[F.lit(n) for n in lengths if p <= n < 2 * p]))
    own = (
        texts.select("_k1", "_k2", words_of(F.col("text")).alias("words"), "ranges")
        .select("_k1", "_k2", "words", F.explode("ranges").alias("r"))
        .select("_k1", "_k2", "words", "r", F.explode(of_length).alias("length"))
        .select("_k1", "_k2", "words", "length", F.explode(F.sequence("r.low", "r.high")).alias("at"))
    )
    own = own.where(F.col("at") + F.col("length") <= F.size("words")).select(
        "_k1", "_k2", "at", "length", *_same(F.col("words"), F.col("at"), F.col("length"))
    )
    hits = own.join(windows, ["length", "_ha", "_hb"])
    by_text = hits.groupBy("_k1", "_k2").agg(
        F.array_sort(F.collect_set(F.struct("at", "length"))).alias("runs"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    # Sorted by start: each run adds what reaches beyond the runs before it.
    covered = F.aggregate(
        "runs",
        F.struct(F.lit(0).alias("n"), F.col("runs").getItem(0)["at"].alias("end")),
        lambda a, r: F.struct(
            (a["n"] + F.greatest(F.lit(0), r["at"] + r["length"] - F.greatest(a["end"], r["at"]))).alias("n"),
            F.greatest(a["end"], r["at"] + r["length"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    return rows, by_text.select("_k1", "_k2", covered.cast("long").alias("n_hit"), "items")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    span: int = SPAN,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``id_col, n_words, n_hit, items, contaminated`` for every row of ``docs``.

    A window is ``span`` consecutive words of an item (a shorter item is one window); a word
    of a text inside any occurrence of a window is hit. ``items`` are the ids of the items with
    occurring windows, as sorted text. A text is contaminated if it has hits and they are a
    twentieth of its words or more.

    Null and empty texts have no words and no hits, items without words no windows. Null ids
    and repeated rows stay; other columns are not read. Empty tables give no rows or no hits.
    Windows are compared by 128-bit hashes. One plan serves benchmarks of every size; Spark
    alone decides which side of a join is broadcast.
    """
    rows, counted = _counted(docs, benchmark, span, gram, id_col, text_col, item_col, item_text_col)
    return rows.join(written(counted, "hits"), ["_k1", "_k2"], "left").select(
        F.col("_id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") * 20 >= F.col("n_words"), F.lit(False)).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated; columns stay."""
    rows, counted = _counted(docs, benchmark, SPAN, GRAM, id_col, text_col, "item_id", "text")
    hit = rows.join(counted.select("_k1", "_k2", "n_hit"), ["_k1", "_k2"])
    dirty = written(hit.where(F.col("n_hit") * 20 >= F.col("n_words")).select("_k1", "_k2").distinct(), "dirty")
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), *_keys(id_col, text_col))
    return keyed.join(dirty, ["_k1", "_k2"], "left_anti").select("_row.*")
