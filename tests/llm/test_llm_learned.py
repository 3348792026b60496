"""Learned operators against plain versions of themselves, and on rows they have not learnt from."""

import zlib

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.llm import quality, queries, toxicity
from tidemark.llm.samples import labelled_sample, unlabelled_sample

SF_DIR = "/root/testdata/sf0.01"

OPERATORS = {"quality": (queries.quality, 4, 2), "toxic": (queries.toxicity, 3, 1)}


@pytest.fixture(scope="module")
def tables(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture(scope="module")
def folders(spark, tables, tmp_path_factory):
    """The tables as they are, and with the labels of all held-out rows turned round."""
    made = {}
    for label, (_, folds, fold) in OPERATORS.items():
        folder = made[label] = str(tmp_path_factory.mktemp(label))
        tables("documents").write.parquet(f"{folder}/documents.parquet")
        held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold
        turned = F.when(held, 1 - F.col(label)).otherwise(F.col(label)).cast("int").alias(label)
        tables("labels").select("doc_id", turned).write.parquet(f"{folder}/labels.parquet")
    return made


@pytest.mark.parametrize("label", OPERATORS)
def test_scores_of_rows_that_are_held_out(spark, tables, folders, label):
    query, folds, fold = OPERATORS[label]
    found = {r.doc_id: r for r in query(spark, SF_DIR).collect()}
    truth = {r.doc_id: r[label] for r in tables("labels").collect()}
    assert set(found) == {r.doc_id for r in tables("documents").select("doc_id").collect()}
    for k, r in found.items():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str(k).encode()) % folds == fold)
    held = [(found[k].predicted, t) for k, t in truth.items() if k in found and found[k].held_out]
    common = max(sum(t for _, t in held), sum(1 - t for _, t in held)) / len(held)
    right = sum(p == t for p, t in held) / len(held)
    # Better than the commoner label for every row, by half of what that leaves wrong.
    assert right >= common + (1 - common) / 2
    # Labels of held-out rows are not looked at.
    again = {r.doc_id: r.score for r in query(spark, folders[label]).collect()}
    assert again == pytest.approx({k: r.score for k, r in found.items()}, abs=1e-9)


def test_quality_scores_are_the_plain_ones(tables):
    docs = tables("documents").select("doc_id", "text")
    model = quality.fit_quality(docs, tables("labels"))
    plain = {}
    for r in docs.collect():
        margin = model.margin(np.array([quality.features(r.text)]))[0]
        plain[r.doc_id] = 1 / (1 + np.exp(-margin))
    assert {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()} == pytest.approx(plain, abs=1e-9)
    # The share of good texts, which the labels of all rows tell, is estimated without bad labels.
    good, all_rows = tables("labels").agg(F.sum("quality"), F.count("quality")).first()
    assert abs(model.prior - good / all_rows) < 0.15


def test_toxicity_scores_are_the_plain_ones(tables):
    docs = tables("documents").select("doc_id", "text").where("doc_id % 5 = 0")
    model = toxicity.fit_toxicity(tables("documents"), tables("labels"))
    describe, plain = toxicity.Describe(model.lexicon), {}
    for r in docs.collect():
        raw = model.trees.predictRaw(Vectors.dense(describe(r.text)))[1]
        plain[r.doc_id] = float(np.clip(np.interp(raw, model.bounds, model.shares), 0, 1))
    assert {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()} == pytest.approx(plain, abs=1e-9)
    # Calibrated: a higher score of the trees never means a smaller share.
    assert (np.diff(model.shares) >= 0).all() and 0 <= model.shares.min() and model.shares.max() <= 1


def test_samples_are_bounded_where_one_id_has_a_third_of_the_rows(spark):
    docs = spark.range(30_000).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "CAST(id AS STRING) AS text")
    labels = docs.selectExpr("doc_id", "1 AS quality")
    # Id 7 stands for its own row and for a third of all.
    for most in (50, 25_000):
        for rows in (
            labelled_sample(docs, labels, "quality", F.lit(True), most, "doc_id", F.col("text"), "text"),
            unlabelled_sample(docs, F.lit(True), most, "doc_id", F.col("text"), "text"),
        ):
            ids = [r.id for r in rows.select("id").collect()]
            assert len(ids) == len(set(ids)) == min(most, 20_000)
    hot = docs.where("doc_id = 7")
    assert [r.text for r in unlabelled_sample(hot, F.lit(True), 10, "doc_id", F.col("text"), "text").collect()] == ["0"]
