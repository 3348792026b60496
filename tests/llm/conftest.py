import os

import public_tokenizers
import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def supplied(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no supplied tables")
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names in use inside."""
    long = " ".join(f"w{k % 977} don't, ÉTÉ" for k in range(20_000))
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [
        (1, "plain words here"), (2, None), (3, ""), (4, " \t\n "), (5, long), (6, passage), (7, "x " + passage),
        (8, "plain words here"), (8, "plain words here"), (None, "no id at all"), (None, None), (9, passage),
        (10, "a<|endoftext|>b İstanbul é́ 각 \x1c ½ 日本語"), (11, "!" * 3000),
    ]
    rows = [(i, t, "x", "y", len(t or "")) for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = "id row run at k1 k2 _k1 words size score label x fingerprint ids start key _place _part _row _id n".split()
    return docs.withColumns({name: F.lit(f"extra {name}") for name in names})
