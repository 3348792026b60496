"""The five stages of the pipeline, each against a plain version of itself, with planted cases."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import quality
from tidemark.llm.queries import TOKENIZER
from tidemark.llm.storage import written

SF_DIR = "/root/testdata/sf0.01"

#: Ids of planted rows.
COPY, NEAR, FAR, PASSAGE, TAKEN = 1_000_000, 2_000_000, 3_000_000, 4_000_000, 5_000_000


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The supplied tables and, for ten of their documents, copies, near ones, less near ones,
    passages that others hold too, and texts that hold a benchmark item."""
    folder = str(tmp_path_factory.mktemp("tables"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy("item_id").collect()]
    items = [t for t in items if len(words_of(t)) >= 13]
    good = docs.join(spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1"), "doc_id", "left_semi")
    rows = [r for r in good.orderBy("doc_id").collect() if 120 <= len(words_of(r.text)) <= 400][:10]
    draw, planted = np.random.default_rng(2), []
    passage = " ".join(words_of(rows[0].text)[20:80])
    for n, r in enumerate(rows):
        words = words_of(r.text)
        near, far = list(words), list(words)
        near[len(words) // 2] = "altered"
        for at in draw.choice(len(far), len(far) // 6, replace=False):
            far[at] = f"other{at}"
        fresh = [f"{w}{n}" for w in words]
        planted += [
            (COPY + r.doc_id, r.text), (NEAR + r.doc_id, " ".join(near)), (FAR + r.doc_id, " ".join(far)),
            (PASSAGE + r.doc_id, " ".join([*fresh[:60], passage, *fresh[60:]])),
            (TAKEN + r.doc_id, " ".join([*words[:40][::-1], items[n % len(items)], *words[40:][::-1]])),
        ]
    extra = spark.createDataFrame(planted, "doc_id long, text string").select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text",
        F.lit("en").alias("lang"), F.lit("planted").alias("source"), F.length("text").cast("long").alias("n_chars"),
    )
    docs.unionByName(extra.select(*docs.columns)).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What goes into each stage and comes out of the last."""
    tables = [spark.read.parquet(f"{folder}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        tables.append(written(stage(spark, tables[-1], folder), f"tested{k}"))
    return [t.collect() for t in tables]


def texts(rows):
    found = {r.doc_id: r.text for r in rows}
    assert len(found) == len(rows)
    return found


def test_rejected_documents_go(spark, folder, stages):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit_quality(docs, labels, ~quality.held_out())
    before, after = texts(stages[0]), texts(stages[1])
    margins = model.margin(np.array([quality.features(t) for t in before.values()]))
    kept = {k for k, m in zip(before, margins) if 1 / (1 + np.exp(-m)) >= 0.7}
    assert 0 < len(kept) < len(before)
    assert after == {k: before[k] for k in kept}


def test_one_document_of_each_group_stays(stages):
    before, after = texts(stages[1]), texts(stages[2])
    sets = {}
    for k, t in before.items():
        w = words_of(lower(t))
        size = max(1, min(5, len(w)))
        sets[k] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}
    roots = {k: k for k in before}

    def root(k):
        while roots[k] != k:
            k = roots[k]
        return k

    for a, b in itertools.combinations(sets, 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if small >= 0.8 * large and len(sets[a] & sets[b]) * 1.8 >= 0.8 * (small + large):
            first, second = sorted((root(a), root(b)))
            roots[second] = first
    assert after == {k: before[k] for k in before if root(k) == k}
    planted = {k for k in before if COPY <= k < FAR and k % COPY in before}
    assert len(planted) > 5 and not planted & set(after)


def test_repeated_passages_go(stages):
    before, after = texts(stages[2]), texts(stages[3])
    words = {k: words_of(t) for k, t in before.items()}
    seen = Counter(tuple(w[i : i + 35]) for w in words.values() for i in range(len(w) - 34))
    cut = set()
    for k, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        if any(gone):
            cut.add(k)
            assert after[k] == " ".join(x for x, g in zip(w, gone) if not g)
        else:
            assert after[k] == before[k]
    assert after.keys() == before.keys() and any(k >= PASSAGE for k in cut)


def test_contaminated_documents_go(spark, folder, stages):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = re.findall(word, lower(r.text))
        n = min(13, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n}
    before, after = texts(stages[3]), texts(stages[4])
    dirty = set()
    for k, t in before.items():
        w, hit = re.findall(word, lower(t)), set()
        for n in {len(window) for window in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
        if hit and 20 * len(hit) >= len(w):
            dirty.add(k)
    assert after == {k: t for k, t in before.items() if k not in dirty}
    assert any(k >= TAKEN for k in dirty)


def checked_pieces(docs, pieces):
    library = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    parts, sequences = {}, {}
    for p in pieces:
        parts.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append(p)
    assert parts.keys() == docs.keys()
    for k, held in parts.items():
        ids = np.array([*library.encode(docs[k] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(held, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start : at].tobytes())
        assert at == len(ids)
    for held in sequences.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048


def test_all_that_is_left_is_packed(stages):
    checked_pieces(texts(stages[4]), stages[5])


def test_the_whole_run_is_its_stages(spark, folder, stages):
    checked_pieces(texts(stages[4]), corpus_pipeline.run(spark, folder).collect())
