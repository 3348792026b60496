"""From raw documents to training sequences, in stages.

Each stage gets what its predecessor kept, written as Parquet and read again, and but for the
last returns rows with the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontamination import clean_documents
from tidemark.llm.quality import described, fit_described, held_out, score_described
from tidemark.llm.queries import THRESHOLD, packed, table
from tidemark.llm.shingle_dedup import SIMILARITY
from tidemark.llm.simhash_dedup import keep_one
from tidemark.llm.storage import written
from tidemark.llm.substring_dedup import remove_repeats

#: No single SQL statement: the first stage is a fitted model, the second needs XXH64.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (a score of 0.7 or more)."""
    # The features are a table beside the rows: no join back, and repeated or missing ids do no harm.
    row = docs.select(F.struct(*docs.columns).alias("row"), "text")
    rows = written(described(row, id_col="row"), "features")
    own = rows.select("row.doc_id", "x")
    model = fit_described(own, table(spark, sf_dir, "labels"), ~held_out())
    return score_described(rows, model).where(F.col("score") >= THRESHOLD).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose five-word shingles are alike by 0.8 or more."""
    return keep_one(docs, similarity=SIMILARITY)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated windows of 35 words.

    A text that holds none stays as it is, one that does becomes its kept words, joined by one
    space. No document goes, also if nothing of it is left. ``n_chars`` is that of the text.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    found = remove_repeats(docs, keep_columns=others, as_is=True).withColumnRenamed("kept_text", "text")
    shorter = F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
    return found.withColumn("n_chars", F.coalesce(shorter, F.col("n_chars"))).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, placed in sequences."""
    return packed(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
