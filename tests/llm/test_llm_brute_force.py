"""Operators against plain versions of themselves, on the supplied tables."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from tidemark.llm import decontamination as winnow
from tidemark.llm.bpe import Ids, PrefixCounts
from tidemark.llm.components import components
from tidemark.llm.hnsw import Graph
from tidemark.llm.packing import Packer, pack_examples
from tidemark.llm.sharding import place, row_at, shard_documents
from tidemark.llm.simhash_dedup import BKTree, fingerprint_links, simhash_groups
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.token_counts import cut_for, prefix_counts, token_counts, tokens_at


@pytest.fixture(scope="module")
def docs(supplied):
    return supplied("documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def library(tokenizer):
    return Tokenizer.from_file(tokenizer)


ODD = [
    "It's they're we'll !!'s ''s x'ré don't I'M <|endoftext|> a<|endoftext|>b !<|startoftext|>'s <|endof",
    "été ÀÉ İstanbul ΣΑΣ ß ﬁ ½ ² 1234 ٣ 한국어 日本語がき", "a\x1cb c d\x85e", "ábc ̣x", "'" * 9,
]


@pytest.mark.parametrize("text", ODD)
def test_prefix_counts_are_the_library_s(library, tokenizer, text):
    want = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(1, len(text) + 1)]
    assert PrefixCounts(tokenizer).encode(text).tolist() == want
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(Ids(tokenizer).encode(text), "<u4").tolist() == ids


def test_token_counts(docs, texts, library, tokenizer):
    for r in token_counts(docs, tokenizer).collect():
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


def test_budgets_need_no_encoding(docs, texts, library, tokenizer):
    counted = prefix_counts(docs.where("doc_id < 20"), tokenizer)
    for r in counted.select("doc_id", cut_for(counted.prefix_counts, 30).alias("cut"), tokens_at(counted.prefix_counts, 100).alias("n")).collect():
        text = texts[r.doc_id]
        assert r.n == len(library.encode(text[:100], add_special_tokens=False).ids)
        assert len(library.encode(text[: r.cut], add_special_tokens=False).ids) <= 30


def test_packing_loses_nothing_and_pads_nothing(docs, texts, library, tokenizer):
    pieces = pack_examples(docs, tokenizer).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == texts.keys()
    for key, parts in by_doc.items():
        parts.sort(key=lambda p: p.start)
        ids = [*library.encode(texts[key], add_special_tokens=False).ids, 1]
        assert b"".join(bytes(p.ids) for p in parts) == np.array(ids, "<u4").tobytes()
        assert {p.doc_tokens for p in parts} == {len(ids)}
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in parts])
        assert [p.offset for p in parts] == [0, *ends[:-1]] and len(parts) <= 64
        assert ends[-1] <= 2048 and ends[-1] & (ends[-1] - 1) == 0


def test_packing_keeps_all_three_limits():
    packer, draw = Packer(256, 5, 100), np.random.default_rng(0)
    sizes = draw.integers(1, 900, 3000)
    for k, n in enumerate(sizes):
        packer.add(k, np.full(n, k, "<u4").tobytes(), int(draw.integers(0, n + 1)))
    packer.finish()
    totals = {}
    for key, _, length, cut, loss, _, sequence, _, _ in packer.ready:
        assert cut == np.full(length, key, "<u4").tobytes()
        total = totals.setdefault(sequence, [0, 0, 0])
        total[0] += length
        total[1] += 1
        total[2] += loss
    assert all(t <= 256 and s <= 5 and w <= 100 for t, s, w in totals.values())
    assert sum(t for t, _, _ in totals.values()) == sizes.sum()


def test_substrings(docs, texts):
    words = {k: re.findall(r"[^\x20\x09-\x0D]+", t) for k, t in texts.items()}
    seen = Counter(tuple(w[i : i + 35]) for w in words.values() for i in range(len(w) - 34))
    removed = 0
    for r in remove_repeats(docs).collect():
        w = words[r.doc_id]
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        assert r.kept_text == " ".join(x for x, g in zip(w, gone) if not g)
        assert (r.n_words, r.n_removed) == (len(w), sum(gone))
        removed += sum(gone)
    assert removed > 0


@pytest.mark.parametrize("window", [2, 3, 6])
def test_short_windows(spark, window):
    draw = np.random.default_rng(window)
    rows = [(k, " ".join(draw.choice(list("abc"), draw.integers(0, 12)))) for k in range(30)]
    seen = Counter(tuple(t.split()[i : i + window]) for _, t in rows for i in range(len(t.split()) - window + 1))
    found = {r.doc_id: r.kept_text for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window).collect()}
    for k, text in rows:
        w = text.split()
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        assert found[k] == " ".join(x for j, x in enumerate(w) if j not in gone)


def smallest(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash(docs, texts):
    marks = {}
    for key, text in texts.items():
        w = text.encode().lower().split()
        runs = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
        marks[key] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    near = [(a, b) for a, b in itertools.combinations(marks, 2) if (marks[a] ^ marks[b]).bit_count() <= 2]
    roots = smallest(marks, near)
    for r in simhash_groups(docs).collect():
        assert r.fingerprint % (1 << 64) == marks[r.doc_id] and r.component_id == roots[r.doc_id]


@pytest.mark.parametrize("shard", [4096, 16])
def test_fingerprints_within_two_bits(spark, shard):
    """Large groups of near fingerprints, in one tree and in many."""
    draw = np.random.default_rng(7)
    base = [int(x) for x in draw.integers(0, 1 << 63, 40)]
    values = set(base)
    for b in base[:20]:
        for _ in range(30):
            b ^= 1 << int(draw.integers(0, 64))
            if draw.random() < 0.5:
                b ^= 1 << int(draw.integers(0, 64))
            values.add(b)
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    near = [(a, b) for a, b in itertools.combinations(values, 2) if ((a ^ b) % (1 << 64)).bit_count() <= 2]
    df = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    found = {r.node: r.root for r in components(fingerprint_links(df, shard=shard)).collect()}
    want = smallest(values, near)
    assert {v: found.get(v, v) for v in values} == want


def test_bk_tree():
    draw = np.random.default_rng(1)
    values = [int(x) for x in draw.integers(0, 1 << 12, 300)]
    tree = BKTree()
    for v in values:
        tree.add(v)
    for q in range(0, 1 << 12, 37):
        assert sorted(tree.within(q, 2)) == sorted({v for v in values if (v ^ q).bit_count() <= 2})


def test_sharding(docs, texts):
    rows = shard_documents(docs, 24).collect()
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 24
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in counts.items())
    assert shard_documents(docs.repartition(5), 24).select("doc_id", "shard", "slot").exceptAll(
        shard_documents(docs, 24).select("doc_id", "shard", "slot")
    ).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 12345])
def test_permutation(n):
    rows = np.arange(n)
    places = place(rows, n, 5)
    assert sorted(places) == list(rows) and (row_at(places, n, 5) == rows).all()


@pytest.mark.parametrize("bits", [1 << 20, 64])
def test_winnowing(spark, supplied, docs, texts, bits, monkeypatch):
    """With a bitmap that tells marks apart and with a full one; with items shorter than a window."""
    monkeypatch.setattr(winnow, "BITS", bits)
    items = supplied("benchmark").union(spark.createDataFrame([(900, "The and"), (901, "of"), (902, "!"), (903, None)], "item_id long, text string"))
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    windows = {}
    for r in items.collect():
        w = re.findall(word, low(r.text))
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(r.item_id))
    for r in winnow.contamination(docs, items).collect():
        w = re.findall(word, low(texts[r.doc_id]))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                held = windows.get(tuple(w[i : i + n]))
                if held:
                    found |= held
                    hit |= set(range(i, i + n))
        assert (r.n_words, r.n_hit, r.items) == (len(w), len(hit), sorted(found))
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))


def test_graph_finds_links_of_dense_and_sparse_groups():
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(40, 32))
    rows = np.concatenate([c + 0.03 * draw.normal(size=(n, 32)) for c, n in zip(centres, draw.integers(1, 120, 40))])
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    truth = unit @ unit.T >= 0.95
    found = Graph(unit).within(unit, 0.95, 32)
    hits = sum(truth[k, f].sum() for k, f in enumerate(found))
    assert hits >= 0.9 * truth.sum()
