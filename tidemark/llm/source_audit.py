"""Op 11: how far the sources of a language differ in their words, by one-hot level products.

A term's *level* in a group (language, source) is its number of occurrences there. With one
indicator column for each (group, level) and one row for each term, the matrix times its own
transpose holds, for any two groups, the number of terms at each pair of levels: every joint
table at once. A divergence between two groups is the sum over their joint table of a price that
depends on the two levels only.

The matrix is cut into blocks of terms; each block's product is taken in whole numbers, as the
sum of the outer products of its rows, of which only the ones are stored. Level 0, which most
terms have in most groups, is not stored either: its part of a joint table is what the rows and
columns of the rest leave over.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shipping import ship
from tidemark.llm.storage import written
from tidemark.llm.words import text_slices

#: A term is kept where so many documents of its language hold it.
LEAST_DOCUMENTS = 3

#: Shares are whole numbers of this unit.
UNIT = 1_000_000_000

#: Terms listed for each group.
TERMS = 200

#: A task hands on its counts when it holds so many.
_HELD = 300_000

#: Ones in a block of the matrix, about.
_BLOCK = 1 << 18

#: Cells of a product that are listed before they are counted.
_CELLS = 1 << 21

#: What stands between terms, ``[\x00-\x40\x5B-\x60\x7B-\x7F]``, becomes a space;
#: A to Z become a to z.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """The terms of a text, in order, as UTF-8."""
    return text.encode().translate(_FOLD).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, term, n, docs`` of what a task has read, a bounded part at a time."""
    held = defaultdict(lambda: (Counter(), Counter()))

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            columns = [
                pa.array([lang] * len(n), pa.string()),
                pa.array([source] * len(n), pa.string()),
                pa.array(list(n), pa.binary()).cast(pa.string()),
                pa.array(list(n.values()), pa.int64()),
                pa.array([docs[term] for term in n], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
        held.clear()

    size = 0
    for batch in batches:
        for start, stop in text_slices(batch.column(2)):
            for lang, source, text in zip(*(c.slice(start, stop - start).to_pylist() for c in batch.columns)):
                words = terms_of(text)
                n, docs = held[lang, source]
                size -= len(n)
                n.update(words)
                docs.update(set(words))
                size += len(n)
            if size > _HELD:
                yield from rows()
                size = 0
    yield from rows()


def kept_terms(
    docs: DataFrame,
    least: int = LEAST_DOCUMENTS,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``lang, term, sources`` (``source, n`` of each source with the term): the terms that
    ``least`` documents of their language hold. Null texts, languages and sources are empty.

    Tasks count what they read and hand on one row for each group and term. All rows of a term
    meet in one place, so both sums need one shuffle; a term has one row at most for each source
    and portion of a task.
    """
    ship(docs.sparkSession)
    columns = [F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    counted = docs.select(*columns).mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    by_source = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources")
    )
    return by_term.where(F.col("docs") >= least).select("lang", "term", "sources")


def _groups(docs: DataFrame, terms: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """``lang, source, total, v, lang_total, blocks`` of every group, also without terms."""
    named = [F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]
    totals = terms.select("lang", F.explode("sources").alias("s")).groupBy("lang", F.col("s.source").alias("source")).agg(
        F.sum("s.n").alias("total"), F.count(F.lit(1)).alias("ones")
    )
    langs = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("ones").alias("ones"))
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    none = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return (
        docs.select(*named).distinct()
        .join(totals.drop("ones"), ["lang", "source"], "left")
        .join(langs, "lang", "left").join(sizes, "lang", "left")
        .select(
            "lang", "source", none("total"), none("v"), none("lang_total"),
            F.coalesce(F.ceil(F.col("ones") / _BLOCK), F.lit(0)).cast("int").alias("blocks"),
        )
    )


def shares(n: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """``1 + floor(UNIT * (n + 1) / size)`` in 64-bit integers, by long division in three steps
    (``UNIT`` is the cube of 1000); exact for sizes up to 9 * 10^15."""
    found, rest = np.zeros(np.broadcast(n, size).shape, dtype=np.int64), np.asarray(n, dtype=np.int64) + 1
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, size)
        found = found * 1000 + more
    return found + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def product(row: np.ndarray, column: np.ndarray, columns: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``i, j, n`` with i < j: the cells above the diagonal of the transpose of a 0-1 matrix times
    the matrix, given its ones. A part at a time: the same cell may come again, its ``n`` add up.

    The product is the sum of the outer products of the rows.
    """
    order = np.lexsort((column, row))
    row, column = row[order], column[order]
    after = np.searchsorted(row, row, side="right") - np.arange(len(row)) - 1
    ends = np.cumsum(after)
    low = 0
    while low < len(row):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + _CELLS, side="right")))
        left = np.repeat(np.arange(low, high), after[low:high])
        step = np.arange(len(left)) - np.repeat(ends[low:high] - after[low:high] - (ends[low - 1] if low else 0), after[low:high])
        cells, n = np.unique(column[left] * columns + column[left + 1 + step], return_counts=True)
        yield cells // columns, cells % columns, n
        low = high


def _levels(ones: pd.DataFrame, groups: pd.DataFrame) -> tuple:
    """Row and column of every one of a block, and of every column its group and level."""
    row = pd.factorize(ones["term"])[0].astype(np.int64)
    of = pd.Index(groups["source"]).get_indexer(ones["source"])
    level = ones["n"].to_numpy(np.int64)
    order = np.lexsort((level, of))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(of[order]) != 0) | (np.diff(level[order]) != 0)
    column = np.empty(len(order), dtype=np.int64)
    column[order] = np.cumsum(new) - 1
    return row, column, of[order][new], level[order][new]


def _block_value(terms: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """What a block of terms adds to the divergence of every ordered pair of groups."""
    groups = groups.sort_values("source")
    n = len(groups)
    size = (groups["total"] + groups["v"]).to_numpy(np.int64)
    row, column, of, level = _levels(terms, groups)
    p, zero = shares(level, size[of]), shares(np.zeros(n, np.int64), size)
    none = price(zero[:, None], zero[None, :])
    # As if one of the two levels were always 0 ...
    value = none * np.int64(row.max() + 1 if len(row) else 0)
    held = np.bincount(column, minlength=len(of))[:, None]
    np.add.at(value, of, held * (price(p[:, None], zero[None, :]) - none[of]))
    np.add.at(value.T, of, held * (price(zero[None, :], p[:, None]) - none.T[of]))
    # ... put right by the cells in which neither is.
    for i, j, times in product(row, column, len(of)):
        a, b = of[i], of[j]
        for x, y, s, t in ((p[i], p[j], a, b), (p[j], p[i], b, a)):
            right = price(x, y) - price(x, zero[t]) - price(zero[s], y) + none[s, t]
            np.add.at(value, (s, t), times * right)
    a, b = (k.ravel() for k in np.indices((n, n)))
    names = groups["source"].to_numpy()
    found = pd.DataFrame({"lang": groups["lang"].iloc[0], "source": names[a], "item": names[b], "value": value.ravel()})
    return found[a != b]


def _block_cells(terms: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """The cells of a block's product, levels above 0."""
    groups = groups.sort_values("source")
    row, column, of, level = _levels(terms, groups)
    names = groups["source"].to_numpy()
    parts = [
        pd.DataFrame({"source": names[of[i]], "level": level[i], "other": names[of[j]], "other_level": level[j], "n_terms": n})
        for i, j, n in product(row, column, len(of))
    ]
    found = pd.concat(parts) if parts else pd.DataFrame(columns=["source", "level", "other", "other_level", "n_terms"])
    return found.assign(lang=groups["lang"].iloc[0])[["lang", "source", "level", "other", "other_level", "n_terms"]]


def _by_block(terms: DataFrame, groups: DataFrame, of_block, layout: str) -> DataFrame:
    """``of_block`` of the ones of every block of terms and of the groups of its language."""
    blocks = groups.select("lang", "blocks").distinct()
    ones = (
        terms.join(blocks, "lang")
        .select("lang", F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block"), "term", F.explode("sources").alias("s"))
        .select("lang", "block", "term", "s.source", "s.n")
    )
    beside = groups.where("blocks > 0").select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", "total", "v"
    )

    def both(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return of_block(left, right)

    return ones.groupBy("lang", "block").cogroup(beside.groupBy("lang", "block")).applyInPandas(both, layout)


def joint_tables(
    docs: DataFrame, least: int = LEAST_DOCUMENTS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """``lang, source, level, other, other_level, n_terms``: for any two sources of a language
    (``source`` before ``other``) the number of kept terms with these two numbers of occurrences,
    neither of which is 0. Odd rows are treated as by :func:`source_divergence`."""
    terms = written(kept_terms(docs, least, text_col, lang_col, source_col), "terms")
    groups = written(_groups(docs, terms, lang_col, source_col), "groups")
    layout = "lang string, source string, level long, other string, other_level long, n_terms long"
    cells = _by_block(terms, groups, _block_cells, layout)
    keys = ["lang", "source", "level", "other", "other_level"]
    return cells.groupBy(*keys).agg(F.sum("n_terms").alias("n_terms"))


def source_divergence(
    docs: DataFrame,
    least: int = LEAST_DOCUMENTS,
    most_terms: int = TERMS,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how the words of every source differ.

    A group is a language and a source that occur together; its share ``p`` of a kept term is
    ``1 + floor(UNIT * (n + 1) / (N + V))`` with ``n`` the term's and ``N`` all kept terms'
    occurrences and ``V`` the language's number of kept terms. The price of ``p`` against ``q``
    is ``floor((p - q)^2 / q)``.

    Part ``pair``: ``item`` is each other source of the language, ``value`` the price summed over
    all kept terms. Part ``term``: ``item`` is a term that occurs in the group and whose share is
    larger than in the whole language, ``value`` its price; the ``most_terms`` first ones.
    ``rank`` counts from 1 in each group and part, larger values first, then by item.

    Null texts, languages and sources are empty text, and an empty language or source is one like
    any other. Texts without terms and languages without kept terms have their groups and pairs
    (of value 0). Repeated rows count again, as documents too. Other columns are not read; an
    empty table gives no rows. Exact while a language has fewer than 9 * 10^15 occurrences.
    """
    terms = written(kept_terms(docs, least, text_col, lang_col, source_col), "terms")
    groups = written(_groups(docs, terms, lang_col, source_col), "groups")

    layout = "lang string, source string, item string, value long"
    summed = _by_block(terms, groups, _block_value, layout).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # Every pair of groups of a language is a row of the result.
    others = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(others, "lang").where("source <> item")
    pairs = pairs.join(summed, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0)))

    of_lang = F.aggregate("sources", F.lit(0).cast("long"), lambda t, s: t + s["n"])
    ones = terms.select("lang", "term", of_lang.alias("lang_n"), F.explode("sources").alias("s")).select(
        "lang", "s.source", F.col("term").alias("item"), "s.n", "lang_n"
    )
    priced = (
        ones.join(groups, ["lang", "source"])
        .withColumns({"p": _share("n", F.col("total") + F.col("v")), "q": _share("lang_n", F.col("lang_total") + F.col("v"))})
        .where("p > q")
        .select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))
    )
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(first).alias("rank")
    listed = priced.select("*", rank).where(F.col("rank") <= most_terms)
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank).unionByName(
        listed.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    )


def _share(n: str, size: Column) -> Column:
    """As :func:`shares`."""
    found, rest = F.lit(0).cast("long"), F.col(n) + 1
    for _ in range(3):
        found = found * 1000 + F.call_function("div", rest * 1000, size)
        rest = F.pmod(rest * 1000, size)
    return found + 1
