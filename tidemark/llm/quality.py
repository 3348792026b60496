"""Op 5: a quality classifier from trusted positives and unlabelled text.

Positive-unlabelled learning: texts known to be good and a sample of all texts, nothing known
to be bad. The class prior (the share of good texts) is estimated first, over all texts: among
those with the best scores, unlabelled text is as dense as that share. Then a small network
over dense features minimises the non-negative unbiased risk: the loss of the unlabelled texts
as negatives, less what the good texts among them account for, never below zero.

Texts are described once; the sample, the prior and the scores come from that table.
"""

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.recent import Recent
from tidemark.llm.samples import fold, labelled_sample, unlabelled_sample
from tidemark.llm.shipping import ship
from tidemark.llm.storage import written
from tidemark.llm.words import text_slices

#: Trusted positives, and unlabelled texts, that a model is fitted on at most.
SAMPLE = 20_000

#: Text is described in terms of these shares (and the logarithm of its length).
FEATURES = (
    "log_words", "distinct", "repeats", "top_word", "word_length", "upper", "capitals", "digits",
    "marks", "mark_runs", "marked_ends", "no_letters", "lines", "repeated_lines", "long_words",
)

#: Sums over words are kept side by side in one integer, each in a field of so many bits:
#: enough for texts of a terabyte.
_FIELD = 40


def _facts(word: str) -> int:
    """Upper-case letters, digits, marks, adjacent marks; whether it ends in two marks, has no
    letters, is in capitals, is long."""
    upper = sum(map(str.isupper, word))
    letters = sum(map(str.isalpha, word))
    digits = sum(map(str.isdigit, word))
    marks = len(word) - letters - digits
    runs = sum(not a.isalnum() and not b.isalnum() for a, b in zip(word, word[1:]))
    ends = len(word) > 1 and not word[-1].isalnum() and not word[-2].isalnum()
    facts = (upper, digits, marks, runs, ends, letters == 0, upper > 1 and upper == letters, len(word) > 20)
    return sum(int(fact) << _FIELD * k for k, fact in enumerate(facts))


_known = Recent(_facts)


def features(text: str | None) -> list[float]:
    """The values of ``FEATURES`` for a whole text; an empty one has no words."""
    words = (text or "").split()
    n = len(words)
    if n == 0:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    total = sum(map(_known.__getitem__, words))
    upper, digits, marks, runs, ends, bare, shouted, long = (
        (total >> _FIELD * k) & ((1 << _FIELD) - 1) for k in range(8)
    )
    characters = sum(map(len, words))
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        float(np.log1p(n)),
        len(counts) / n,
        sum(map(eq, words, words[1:])) / n,
        max(counts.values()) / n,
        characters / n / 10,
        upper / characters,
        shouted / n,
        digits / characters,
        marks / characters,
        runs / characters,
        ends / n,
        bare / n,
        len(lines) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        long / n,
    ]


@dataclass
class Model:
    """A network with one hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: float
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(x @ self.hidden + self.bias) @ self.out + self.shift


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


#: Shares of the held-out positives that lie below the thresholds tried for the class prior.
_CUTS = np.linspace(0, 0.95, 96)

#: Given thresholds, the number of unlabelled scores at or above each, and of all.
Above = Callable[[np.ndarray], tuple[np.ndarray, int]]


def class_prior(positive: np.ndarray, above: Above, confidence: float = 0.1) -> float:
    """The share of positives among the unlabelled, from the scores of both.

    The least ratio of the two sides' shares above a threshold, each with a bound on its
    error: at the top of the scores, unlabelled texts are positives.
    """
    n = len(positive)
    if n == 0:
        return 0.5
    cuts = np.quantile(positive, _CUTS)
    counts, m = above(cuts)
    if m == 0:
        return 0.5
    p = 1 - np.searchsorted(np.sort(positive), cuts) / n
    u = counts / m
    slack = np.sqrt(np.log(4 / confidence) / 2) * (1 / np.sqrt(n) + 1 / np.sqrt(m))
    best = int(np.argmin((u + slack) / np.maximum(p, 1e-9)))
    return float(np.clip(u[best] / p[best], 0.02, 0.98))


def fit(
    positive: np.ndarray, unlabelled: np.ndarray, above: Callable[[Model], Above], steps: int = 400, seed: int = 5
) -> Model:
    """Fit on feature rows; with a side empty, every score is the same. ``above`` counts the
    scores that a model gives to all unlabelled rows, not only those it is fitted on."""
    width, units = len(FEATURES), 12
    both = np.concatenate([positive, unlabelled]) if len(positive) + len(unlabelled) else np.zeros((1, width))
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    start = np.random.default_rng(seed)

    def fresh(prior: float) -> Model:
        return Model(
            mean, scale, start.normal(0, 0.5, (width, units)), np.zeros(units), start.normal(0, 0.3, units), 0.0, prior
        )

    if len(positive) < 4 or len(unlabelled) < 4:
        model = fresh(0.5)
        model.out = np.zeros(units)
        return model
    # The prior comes from a model that tells the two samples apart; its positives are rows it
    # has not seen.
    apart = fresh(0.5)
    _train(apart, positive[::2], unlabelled[::2], steps // 2, plain=True)
    prior = class_prior(apart.margin(positive[1::2]), above(apart))
    model = fresh(prior)
    _train(model, positive, unlabelled, steps)
    return model


def _train(model: Model, positive: np.ndarray, unlabelled: np.ndarray, steps: int, plain: bool = False) -> None:
    """Full-batch Adam. ``plain``: positives against unlabelled, equally weighted."""
    x = np.clip((np.concatenate([positive, unlabelled]) - model.mean) / model.scale, -8, 8)
    n, m, prior = len(positive), len(unlabelled), model.prior
    names = ("hidden", "bias", "out", "shift")
    first = {k: np.zeros_like(np.asarray(getattr(model, k), dtype=float)) for k in names}
    second = {k: v.copy() for k, v in first.items()}
    for step in range(1, steps + 1):
        inner = np.tanh(x @ model.hidden + model.bias)
        z = inner @ model.out + model.shift
        p = _sigmoid(z)
        # Logistic loss: its derivative is p - 1 for a positive and p for a negative.
        slope = np.zeros(n + m)
        if plain:
            slope[:n], slope[n:] = (p[:n] - 1) / n, p[n:] / m
        else:
            negative = np.logaddexp(0, z)
            risk = negative[n:].mean() - prior * negative[:n].mean()
            if risk >= 0:
                slope[:n] = prior * (p[:n] - 1) / n - prior * p[:n] / n
                slope[n:] = p[n:] / m
            else:
                # Below zero only by over-fitting: step back on this part alone.
                slope[:n], slope[n:] = prior * p[:n] / n, -p[n:] / m
        back = np.outer(slope, model.out) * (1 - inner**2)
        found = {
            "hidden": x.T @ back + 1e-4 * model.hidden,
            "bias": back.sum(axis=0),
            "out": inner.T @ slope + 1e-4 * model.out,
            "shift": slope.sum(),
        }
        for k in names:
            first[k] = 0.9 * first[k] + 0.1 * found[k]
            second[k] = 0.999 * second[k] + 0.001 * found[k] ** 2
            move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            setattr(model, k, getattr(model, k) - 0.03 * move)


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, x``: the features of every row of ``docs``, whose whole texts are read here."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_slices(batch.column(1)):
                part = batch.slice(start, stop - start)
                values = [features(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values, pa.list_(pa.float64()))], ["id", "x"])

    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(compute, f"id {kind}, x array<double>").withColumnRenamed("id", id_col)


def _margins(x: Column, model: Model, of: Callable[[np.ndarray], np.ndarray]) -> Column:
    """``of`` the model's margins, one number for each row."""

    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = np.stack(batch.to_list()) if len(batch) else np.zeros((0, len(FEATURES)))
            yield pd.Series(of(model.margin(rows)).astype(float))

    return F.pandas_udf(compute, "double")(x)


def fit_described(
    rows: DataFrame,
    labels: DataFrame,
    allowed: Column | None = None,
    label_col: str = "quality",
    sample: int = SAMPLE,
    id_col: str = "doc_id",
) -> Model:
    """As :func:`fit_quality`, from what :func:`described` gave (read some four times)."""
    allowed = F.lit(True) if allowed is None else allowed
    x = F.col("x")
    good = labelled_sample(rows, labels.where(F.col(label_col) == 1), label_col, allowed, sample, id_col, x, "x")
    some = unlabelled_sample(rows, allowed, sample, id_col, x, "x")
    sides = []
    for side in (good, some):
        values = np.array([r.x for r in side.select("x").collect()], dtype=float).reshape(-1, len(FEATURES))
        # In an order of its own, so that the fit does not depend on the order of tasks.
        values = values[np.lexsort(values.T)]
        sides.append(values[np.random.default_rng(1).permutation(len(values))])

    def above(model: Model) -> Above:
        def count(cuts: np.ndarray) -> tuple[np.ndarray, int]:
            place = _margins(x, model, lambda margins: np.searchsorted(cuts, margins, side="right"))
            # One row for each number of cuts that a score reaches.
            held = rows.where(allowed).groupBy(place.cast("int").alias("place")).count().collect()
            counts = np.zeros(len(cuts) + 1, dtype=np.int64)
            for r in held:
                counts[r["place"]] = r["count"]
            return counts[::-1].cumsum()[::-1][1:], int(counts.sum())

        return count

    return fit(*sides, above)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    allowed: Column | None = None,
    label_col: str = "quality",
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """A model of rows with label 1 against all texts; ``allowed`` says which rows may be used.

    Fitted on at most ``sample`` trusted positives and ``sample`` unlabelled texts (the ids with
    the smallest hashes, one row for each id), whatever the size of the tables. The class prior
    is that of all rows allowed: a model's scores of them are counted between thresholds. Rows
    labelled 0 serve as unlabelled text only. Without labels or texts all scores are 0.5.
    """
    return fit_described(written(described(docs, id_col, text_col), "features"), labels, allowed, label_col, sample, id_col)


def score_described(rows: DataFrame, model: Model) -> DataFrame:
    """What :func:`described` gave, with the column ``score`` in place of ``x``."""
    score = _margins(F.col("x"), model, _sigmoid)
    return rows.withColumn("score", score).drop("x")


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` for every row of ``docs``, 0 to 1, higher for better text.

    Every whole text is scored where it is read. Null and empty texts have a score as well
    (that of a text without words); null ids and repeated rows stay; no other column is read.
    """
    return score_described(described(docs, id_col, text_col), model)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows from which no label is learnt."""
    return fold(id_col, 4) == 2
