"""Op 1: toxicity scores by gradient-boosted trees over dense features, calibrated.

The features of a text are densities: of words of a lexicon (whole words, and beginnings of
words), of words in the neighbourhood of an address to the reader, of capitals, punctuation
and obfuscated spellings. The lexicon is learnt from labelled rows; the trees are fitted on
one part of them and an isotonic regression on the other turns their scores into shares.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.recent import Recent
from tidemark.llm.samples import fold, labelled_sample
from tidemark.llm.shipping import ship
from tidemark.llm.storage import written
from tidemark.llm.words import text_slices

#: Labelled rows that a model is fitted on at most.
SAMPLE = 20_000

#: Lexicon entries of each kind at most.
ENTRIES = 2_000

FEATURES = (
    "strong", "weak", "stems", "strong_count", "stem_count", "near_reader", "reader", "capitals",
    "marks", "exclamations", "obfuscated", "log_words",
)

#: Words that address the reader, in English, German, French and Spanish.
_READER = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous "
    "votre vos tú ti tuyo usted ustedes vosotros".split()
)
#: Characters that stand for letters in disguised words.
_DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": ""})

_EDGE = re.compile(r"^\W+|\W+$")

#: Words to both sides of a lexicon word in which an address to the reader counts.
_NEAR = 5

#: Rows that a task hands on at once while it lists the terms of texts.
_TERMS_AT_ONCE = 50_000

#: Lengths of beginnings of words.
STEMS = range(3, 9)


def plain_word(word: str) -> tuple[str, bool]:
    """A word without marks at its edges, lower case and undisguised; whether it was disguised."""
    word = _EDGE.sub("", word)
    letters = word.lower()
    if letters.isalpha() or not any(map(str.isalpha, letters)):
        return letters, False
    shown = letters.translate(_DISGUISE)
    shown = "".join(filter(str.isalpha, shown))
    return shown, True


def beginnings(plain: str) -> list[str]:
    return [plain[:k] for k in STEMS if k < len(plain)]


@dataclass
class Lexicon:
    """Words, by how much oftener toxic texts hold them, and beginnings of words."""

    strong: frozenset[str] = frozenset()
    weak: frozenset[str] = frozenset()
    stems: frozenset[str] = frozenset()


@dataclass
class Describe:
    """Features of texts under a lexicon."""

    lexicon: Lexicon
    _known: Recent = field(init=False, repr=False)

    def __post_init__(self):
        self._known = Recent(self._flags)

    def _flags(self, word: str) -> int:
        plain, disguised = plain_word(word)
        upper = sum(map(str.isupper, word))
        return (
            (plain in self.lexicon.strong)
            | (plain in self.lexicon.weak) << 1
            | (not self.lexicon.stems.isdisjoint(beginnings(plain))) << 2
            | (plain in _READER) << 3
            | (upper > 1 and upper == sum(map(str.isalpha, word))) << 4
            | (not word[-1].isalnum()) << 5
            | ("!" in word) << 6
            | disguised << 7
        )

    def __call__(self, text: str | None) -> list[float]:
        """The values of ``FEATURES``; an empty text has zeros."""
        words = (text or "").split()
        n = len(words)
        if n == 0:
            return [0.0] * len(FEATURES)
        flags = np.fromiter(map(self._known.__getitem__, words), dtype=np.uint8, count=n)
        strong, weak, stem, reader, capitals, marks, shouts, disguised = (
            int(x) for x in np.unpackbits(flags[:, None], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        )
        near = 0
        if reader and strong + stem:
            at = np.flatnonzero(flags & 8)
            for place in np.flatnonzero(flags & 5):
                k = np.searchsorted(at, place - _NEAR)
                near += k < len(at) and at[k] <= place + _NEAR
        return [
            strong / n,
            weak / n,
            stem / n,
            float(min(strong, 10)),
            float(min(stem, 10)),
            near / n,
            reader / n,
            capitals / n,
            marks / n,
            shouts / n,
            disguised / n,
            float(np.log1p(n)),
        ]


@dataclass
class Model:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    #: Steps of the calibration: bounds of the trees' scores, and shares.
    bounds: np.ndarray
    shares: np.ndarray


def learn_lexicon(rows: DataFrame, entries: int = ENTRIES, least: int = 5) -> Lexicon:
    """Terms that at least ``least`` toxic texts hold and others hold far less often.

    ``rows``: ``label, text``. Each text counts once for a term. Of each kind the ``entries``
    terms with the largest weights are kept.
    """

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for batch in batches:
            for label, text in zip(batch["label"], batch["text"]):
                words = {plain_word(w)[0] for w in set(text.split())}
                out += [("word", w, label) for w in words if w]
                out += [("stem", s, label) for s in {s for w in words for s in beginnings(w)}]
                if len(out) >= _TERMS_AT_ONCE:
                    yield pd.DataFrame(out, columns=["kind", "term", "label"])
                    out = []
        yield pd.DataFrame(out, columns=["kind", "term", "label"])

    ship(rows.sparkSession)
    total = rows.agg(F.coalesce(F.sum("label"), F.lit(0.0)), F.count(F.lit(1))).first()
    bad, clean = total[0], total[1] - total[0]
    held = F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("clean")
    counted = rows.mapInPandas(terms, "kind string, term string, label double").groupBy("kind", "term").agg(*held)
    rate = ((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    weighed = counted.where(F.col("bad") >= least).withColumn("weight", F.log(rate)).where("weight > 1")
    best = {}
    for kind in ("word", "stem"):
        # By how many toxic texts a term explains, then by name.
        order = [F.desc(F.col("weight") * F.col("bad")), "term"]
        best[kind] = weighed.where(F.col("kind") == kind).orderBy(*order).limit(entries).collect()
    return Lexicon(
        frozenset(r.term for r in best["word"] if r.weight > 3),
        frozenset(r.term for r in best["word"] if r.weight <= 3),
        frozenset(r.term for r in best["stem"] if r.weight > 3),
    )


def _described(rows: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    describe = Describe(lexicon)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for start, stop in text_slices(texts):
                part = batch.slice(start, stop - start)
                values = np.array([describe(t.as_py()) for t in part.column("text")]).T
                kept = [part.column(c) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, values)], [*keep, *FEATURES])

    ship(rows.sparkSession)
    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*kinds, *[f"{c} double" for c in FEATURES]])
    found = rows.select(*keep, "text").mapInArrow(compute, schema)
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    allowed: Column | None = None,
    label_col: str = "toxic",
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 20,
    seed: int = 1,
) -> Model:
    """A model of the labelled rows for which ``allowed`` holds, ``sample`` at most.

    Two thirds of them (by a hash of the id) give the lexicon and the trees, the rest the
    calibration. Without both labels among the rows every score is 0.
    """
    allowed = F.lit(True) if allowed is None else allowed
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(labelled_sample(docs, labels, label_col, allowed, sample, id_col, text, "text"), "toxicity")
    part = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(3))
    train, rest = rows.where(part > 0), rows.where(part == 0)
    if train.select("label").distinct().count() < 2 or rest.select("label").distinct().count() < 2:
        return Model(Lexicon(), None, np.zeros(1), np.zeros(1))
    lexicon = learn_lexicon(train)
    described = written(_described(rows, lexicon, ["id", "label"]).select("id", "label", "features"), "features")
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=3, stepSize=0.3, seed=seed
    ).fit(described.where(part > 0).select("label", "features"))
    raw = vector_to_array("rawPrediction")[1].alias("raw")
    scored = trees.transform(described.where(part == 0)).select("label", raw)
    fitted = IsotonicRegression(featuresCol="raw", labelCol="label").fit(scored)
    return Model(lexicon, trees, fitted.boundaries.toArray(), fitted.predictions.toArray())


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` for every row of ``docs``: the share of toxic texts to expect.

    Every whole text is scored where it is read. Null and empty texts have the score of a text
    without words; null ids and repeated rows stay; no other column is read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if model.trees is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0.0).alias("score"))
    raw = vector_to_array("rawPrediction")[1].alias("raw")
    scored = model.trees.transform(_described(rows, model.lexicon, ["id"])).select("id", raw)
    bounds, shares = model.bounds, model.shares

    def calibrate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.clip(np.interp(batch.to_numpy(), bounds, shares), 0, 1))

    score = F.pandas_udf(calibrate, "double")("raw")
    return scored.select(F.col("id").alias(id_col), score.alias("score"))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows from which no label is learnt."""
    return fold(id_col, 3) == 1
