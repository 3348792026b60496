"""Every operator over odd rows and over empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.decontamination import clean_documents, contamination
from tidemark.llm.embedding_dedup import embedding_groups
from tidemark.llm.packing import pack_examples
from tidemark.llm.quality import fit_quality, score_quality
from tidemark.llm.sharding import shard_documents
from tidemark.llm.simhash_dedup import keep_one, simhash_groups
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.token_counts import token_counts
from tidemark.llm.toxicity import fit_toxicity, score_toxicity
from tidemark.llm.url_filter import judge_captures


def benchmark_of(docs):
    return docs.where("doc_id in (2, 3, 6)").selectExpr("doc_id AS item_id", "text")


OPERATORS = {
    "sharding": lambda d, tok: shard_documents(d, 24),
    "packing": lambda d, tok: pack_examples(d, tok).where("start = 0"),
    "token_counts": lambda d, tok: token_counts(d, tok),
    "simhash": lambda d, tok: simhash_groups(d),
    "substrings": lambda d, tok: remove_repeats(d),
    "contamination": lambda d, tok: contamination(d, benchmark_of(d)),
    "quality": lambda d, tok: score_quality(d, fit_quality(d, d.selectExpr("doc_id", "1 AS quality"))),
    "toxicity": lambda d, tok: score_toxicity(d, fit_toxicity(d, d.selectExpr("doc_id", "1 AS toxic"))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_result_for_every_row(odd_docs, tokenizer, name):
    found = OPERATORS[name](odd_docs, tokenizer).select("doc_id").collect()
    ids = [r.doc_id for r in odd_docs.select("doc_id").collect()]
    assert sorted((r.doc_id or 0) for r in found) == sorted(i or 0 for i in ids)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(odd_docs, tokenizer, name):
    assert OPERATORS[name](odd_docs.where("false"), tokenizer).count() == 0


def test_copies_and_passages(odd_docs):
    found = {(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(odd_docs, keep_columns=("lang",)).collect()}
    assert {(6, 40, 40, ""), (7, 41, 40, "x"), (9, 40, 40, ""), (2, 0, 0, ""), (1, 3, 0, "plain words here")} <= found
    groups = {r.doc_id: r.component_id for r in simhash_groups(odd_docs.where("doc_id is not null")).collect()}
    assert groups[8] == groups[1] == 1 and groups[9] == groups[6] == 6 and groups[3] == groups[2] == groups[4] == 2
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    # Fewer rows than components: copies of an id stay once; rows without an id once per text.
    assert kept.where("doc_id = 8").count() == 0 and kept.where("doc_id is null").count() == 2
    clean = clean_documents(odd_docs, benchmark_of(odd_docs))
    assert clean.columns == odd_docs.columns
    assert not clean.where("doc_id in (6, 7, 9)").count() and clean.count() == odd_docs.count() - 3


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (9, [2.0, 0.1]), (1, [0.0, 1.0]), (2, None), (4, [0.0, 0.0]),
        (6, [nan, 1.0]), (7, [1.0, None]), (8, [inf, 0.0]), (None, [1.0, 0.0]), (10, [1.0]), (11, []),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit(1) for c in ("id", "node", "shard", "h1", "a", "b", "w", "size")}
    )
    found = sorted(
        ((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in embedding_groups(vectors).collect()
    )
    assert found == [
        (0, 0, None, False), (1, 0, 1, True), (2, 0, 2, True), (3, 3, 3, True), (3, 3, 3, True), (4, 0, 4, True),
        (5, 3, 3, False), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 3, 3, False), (10, 0, 10, True),
        (11, 0, 11, True),
    ]
    assert embedding_groups(vectors.where("false")).count() == 0


def test_captures(spark):
    entries = spark.createDataFrame(
        [
            ("Bad.org", "block", "2024-01-10"), ("bad.org", "allow", "2024-02-01"), ("bad.org", "block", "2024-02-01"),
            ("bad.org", "allow", "2024-03-01"), ("a.bad.org/ok/", "allow", "2024-01-15"), (None, "block", "2024-01-01"),
            ("x.net", None, "2024-01-01"), ("y.net", "block", None),
        ],
        "rule string, action string, day string",
    ).select("rule", "action", F.col("day").cast("timestamp_ntz").alias("since"))
    captures = [
        (1, "http://a.bad.org/x", "2024-01-09"), (2, "http://a.bad.org/x", "2024-01-10"), (3, "https://u@A.BAD.org:80/ok/y", "2024-01-20"),
        (4, "http://bad.org", "2024-02-10"), (5, "http://bad.org", "2024-03-01"), (6, None, "2024-02-10"), (7, "http://bad.org", None),
        (8, "no url", "2024-02-10"), (9, "http://notbad.org/", "2024-02-10"), (4, "http://bad.org", "2024-02-10"),
    ]
    pages = spark.createDataFrame(captures, "page_id long, url string, day string").select(
        "page_id", "url", F.col("day").cast("timestamp_ntz").alias("fetched"), F.lit(1).alias("rule"), F.lit(2).alias("host")
    )
    found = sorted((r.page_id, r.rule, r.blocked) for r in judge_captures(pages, entries).collect())
    assert found == [
        (1, None, False), (2, "bad.org", True), (3, "a.bad.org/ok/", False), (4, "bad.org", True), (4, "bad.org", True),
        (5, "bad.org", False), (6, None, False), (7, None, False), (8, None, False), (9, None, False),
    ]
    assert judge_captures(pages.where("false"), entries).count() == 0
    assert not judge_captures(pages, entries.where("false")).where("blocked").count()


def test_stages_keep_the_columns_and_survive_odd_rows(spark, odd_docs, tmp_path):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic").write.parquet(f"{folder}/labels.parquet")
    benchmark_of(docs).write.parquet(f"{folder}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, docs.where("false")):
            assert stage(spark, rows, folder).columns == docs.columns
    assert corpus_pipeline.run(spark, folder).count() >= 0
    assert len(corpus_pipeline.STAGES) == 5
