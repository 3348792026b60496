"""Whole jobs: what an operator must not leave out."""

import itertools

import numpy as np
import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm import embedding_dedup, shingle_dedup, simhash_dedup
from tidemark.llm.shingle_dedup import node_of, shingle_groups, shingles
from tidemark.llm.simhash_dedup import keep_one
from tidemark.llm.url_filter import judge_captures, timeline


def near_copies(seed=5):
    """Texts, and copies with a growing part of their words changed."""
    draw, rows = np.random.default_rng(seed), []
    for _ in range(20):
        words = [f"w{k}" for k in draw.integers(0, 3000, 200)]
        for edits in range(0, 12):
            copy = list(words)
            for at in draw.choice(len(copy), edits, replace=False):
                copy[at] = f"x{draw.integers(0, 1 << 30)}"
            rows.append((len(rows), " ".join(copy)))
    return rows + [(len(rows), "short"), (len(rows) + 1, "Short "), (len(rows) + 2, ""), (len(rows) + 3, " \t")]


@pytest.mark.parametrize("shard", [2048, 4])
def test_near_copies_down_to_four_fifths(spark, shard):
    rows = near_copies()
    sets = [(k, set(shingles(t).tolist())) for k, t in rows]
    near = [(a, b) for (a, s), (b, t) in itertools.combinations(sets, 2) if len(s & t) >= 0.8 * len(s | t)]
    roots = {k: k for k, _ in rows}
    for _ in rows:
        for a, b in near:
            roots[a] = roots[b] = min(roots[a], roots[b])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    nodes = {r.doc_id: r.node for r in docs.select("doc_id", node_of("text").alias("node")).collect()}
    found = {r.node: r.root for r in shingle_groups(docs, shard=shard).collect()}
    groups = {}
    for k, node in nodes.items():
        groups.setdefault(found.get(node, node), set()).add(k)
    want = {}
    for k, root in roots.items():
        want.setdefault(root, set()).add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    kept = {r.doc_id for r in keep_one(docs, similarity=0.8).collect()}
    assert kept == set(want)


@pytest.mark.parametrize("shard", [2048, 4])
def test_candidates_are_fingerprints_of_one_shard_within_the_radius(spark, shard):
    rows = [r for r in near_copies()[:120] if r[0] % 12 < 6]
    docs = spark.createDataFrame(rows, "node long, text string").withColumn("node", node_of("text"))
    sketches = shingle_dedup._sketches(docs.select("text"), "text", 5).cache()
    prints = {r.node: int.from_bytes(r.sketch, "big") for r in sketches.collect()}
    for node, text in ((r.node, r.text) for r in docs.collect()):
        hashes = shingles(text).tolist()
        mixed = []
        for h in hashes:
            for step in range(1, shingle_dedup.BITS // 64 + 1):
                z = (h + step * 0x9E3779B97F4A7C15) % (1 << 64)
                z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
                z = (z ^ z >> 27) * 0x94D049BB133111EB % (1 << 64)
                mixed.append((z ^ z >> 31).to_bytes(8, "little"))
        words = len(mixed) // len(hashes)
        lines = [b"".join(mixed[k * words : (k + 1) * words]) for k in range(len(hashes))]
        bits = [sum(int.from_bytes(line, "big") >> k & 1 for line in lines) * 2 > len(lines) for k in range(shingle_dedup.BITS)]
        assert prints[node] == sum(1 << k for k, bit in enumerate(bits) if bit)
    drawn = shingle_dedup.draws(len(rows), 0.8)
    at = lambda value, bit: value >> shingle_dedup.BITS - 1 - int(bit) & 1
    keys = {n: {(d, tuple(at(v, b) for b in bits)) for d, bits in enumerate(drawn)} for n, v in prints.items()}
    want = {
        (a, b) for a, b in itertools.combinations(sorted(prints), 2)
        if keys[a] & keys[b] and (prints[a] ^ prints[b]).bit_count() <= 200
    }
    shards = shingle_dedup._shards(sketches, drawn).join(sketches, "node").withColumn("root", F.col("node"))
    pairs = shingle_dedup._candidates(shards, 200, False, shard)
    assert len(want) > 20 and {(r.a, r.b) for r in pairs.collect()} == want
    # A tight group is joined at one pair a text.
    joined = shingle_dedup._candidates(shards, 200, True, shard).collect()
    assert {(r.a, r.b) for r in joined} <= want and joined


@pytest.mark.parametrize("similarity", [None, 0.8])
def test_one_row_of_each_group_where_an_id_stands_for_two_texts(spark, similarity):
    first, second, third = (" ".join(f"{c}{k}" for k in range(50)) for c in "abc")
    rows = [(1, first), (1, second), (1, second), (2, first), (0, third), (1, third), (3, second)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id, r.text) for r in keep_one(docs, similarity=similarity).collect())
    assert kept == [(0, third), (1, first), (1, second)]


@pytest.mark.parametrize("similarity", [None, 0.8])
def test_texts_that_share_a_number_both_stay(spark, monkeypatch, similarity):
    few = lambda text: F.xxhash64(F.coalesce(F.col(text), F.lit(""))).bitwiseAND(7)
    for module in (shingle_dedup, simhash_dedup):
        monkeypatch.setattr(module, "node_of", few)
    rows = [(k, " ".join(f"{k % 30}x{w}" for w in range(40))) for k in range(60)]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string"), similarity=similarity)
    assert kept.columns == ["doc_id", "text"]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == rows[:30]


def test_audit_counts_queries_with_few_links(monkeypatch):
    """A narrow beam that is blind for all but a large tight group."""

    class Blind:
        def __init__(self, unit, seed):
            self.unit = unit

        def within(self, queries, least, width):
            found = [np.flatnonzero(row) for row in queries @ self.unit.T >= least]
            return [f if width >= 128 or len(f) > 20 else f[:0] for f in found]

    monkeypatch.setattr(embedding_dedup, "Graph", Blind)
    draw = np.random.default_rng(2)
    tight = draw.normal(size=32) + 0.002 * draw.normal(size=(3000, 32))
    vectors = np.concatenate([tight, draw.normal(size=(30, 32))])
    n = len(vectors)
    assert embedding_dedup.Shard(np.arange(n), vectors, np.ones(n, int), 0.95, 0).width >= 128


def test_path_rules_keep_their_case(spark):
    day = F.lit("2024-01-10").cast("timestamp_ntz")
    entries = spark.createDataFrame([("Example.org/Wiki/", "block")], "rule string, action string").withColumn("since", day)
    urls = [(1, "http://EXAMPLE.org/Wiki/a"), (2, "http://example.org/wiki/a")]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("fetched", day)
    found = sorted((r.page_id, r.rule, r.blocked) for r in judge_captures(pages, entries).collect())
    assert found == [(1, "example.org/Wiki/", True), (2, None, False)]


def test_long_urls_are_cut_by_position(spark):
    day = F.lit("2024-01-10").cast("timestamp_ntz")
    deep = "x.org/" + "a/" * 20_000
    rules = [("x.org/a/a/", "block"), (deep, "allow"), (deep + "b/", "block"), ("x.org/é/", "block"), ("org", "block")]
    entries = spark.createDataFrame(rules, "rule string, action string").withColumn("since", day)
    urls = [
        (1, "http://" + deep + "c"), (2, "http://x.org/a/a"), (3, "http://x.org/a/a/?q"), (4, "http://x.org/é/ü"),
        (5, "http://" + "a." * 5000 + "x.org//"), (6, "http://x.org/"),
    ]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("fetched", day)
    found = sorted((r.page_id, r.n_active, r.rule) for r in judge_captures(pages, entries).collect())
    assert found == [(1, 3, deep), (2, 1, "org"), (3, 2, "x.org/a/a/"), (4, 2, "x.org/é/"), (5, 1, "org"), (6, 1, "org")]


def test_rules_of_many_entries_are_met_by_time(spark):
    draw = np.random.default_rng(3)
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    # Entries crowd at the start, as a rule's may; two are at one instant.
    since = np.unique(np.concatenate([(draw.random(400) ** 6 * 500_000).astype(int), [0, 1, 2, 500_000]])).tolist()
    listed = [("x.org", ("block", "allow")[k % 2], s) for k, s in enumerate(since)] + [("x.org", "block", since[1])]
    listed += [("one.org", "block", 77)]
    entries = spark.createDataFrame(listed, "rule string, action string, s long").select(
        "rule", "action", (start + F.make_dt_interval(secs=F.col("s"))).alias("since")
    )
    times = [-1, 0, 1, 2, 77, 499_999, 500_000, 10**8, *draw.integers(0, 500_000, 300).tolist()]
    times += [s + d for s in since[::7] for d in (-1, 0, 1)]
    asked = [(k, h, t) for k, (h, t) in enumerate((h, t) for t in times for h in ("x.org", "one.org"))]
    pages = spark.createDataFrame(asked, "page_id long, host string, t long").select(
        "page_id", F.concat(F.lit("http://"), "host").alias("url"), (start + F.make_dt_interval(secs=F.col("t"))).alias("fetched")
    )

    def action(host, t):
        said = [(s, a) for h, a, s in listed if h == host and s <= t]
        return max(said)[1] if said else None

    found = {r.page_id: (r.n_active, r.action) for r in judge_captures(pages, entries).collect()}
    expected = {k: (int(action(h, t) is not None), action(h, t)) for k, h, t in asked}
    assert found == expected


def test_timelines_stay_small(spark):
    rows = [(1, 1, f"2024-01-01 00:00:{k % 60:02d}") for k in range(50)] + [(1, 1, "2025-01-01 00:00:00"), (2, 2, "2024-05-05 00:00:00")]
    starts = spark.createDataFrame(rows, "k1 long, k2 long, day string").selectExpr("k1", "k2", "cast(day as timestamp_ntz) valid_from")
    following = F.lead("valid_from").over(Window.partitionBy("k1").orderBy("valid_from"))
    intervals = starts.select("k1", "k2", F.lit("r").alias("rule"), F.lit("block").alias("action"), "valid_from", following.alias("valid_to"))
    assert timeline(intervals)[1].count() <= 3 * len(rows)


def test_a_written_shard_answers_as_before():
    draw = np.random.default_rng(4)
    vectors = np.repeat(draw.normal(size=(300, 16)), 3, axis=0) + 0.05 * draw.normal(size=(900, 16))
    shard = embedding_dedup.Shard(np.arange(900) * 7, vectors, np.ones(900, int), 0.95, 0)
    again = embedding_dedup.Shard.from_bytes(shard.to_bytes(), 0.95)
    assert again.width == shard.width
    asked = np.arange(900) * 7
    answers = [[(k, n, near.tolist()) for k, n, near in s.links(asked, vectors)] for s in (shard, again)]
    assert answers[0] == answers[1] and len(answers[0]) > 800


def test_rows_of_a_graph_hold_no_node_twice():
    draw = np.random.default_rng(6)
    vectors = np.concatenate([draw.normal(size=16) + 0.02 * draw.normal(size=(400, 16)), draw.normal(size=(300, 16))])
    graph = embedding_dedup.Graph(vectors / np.linalg.norm(vectors, axis=1)[:, None])
    for name, rows in graph.arrays().items():
        for row in rows if name.startswith("links") else ():
            held = row[row >= 0]
            assert len(np.unique(held)) == len(held)


def test_links_against_brute_force_in_many_blocks(spark, monkeypatch):
    """End to end, with a group of near copies of a third of the rows, small shards and blocks."""
    monkeypatch.setattr(embedding_dedup, "SHARD_BYTES", 60_000)
    monkeypatch.setattr(embedding_dedup, "BLOCK_BYTES", 20_000)
    draw = np.random.default_rng(6)
    hot = draw.normal(size=16) + 0.02 * draw.normal(size=(400, 16))
    pairs = np.repeat(draw.normal(size=(200, 16)), 2, axis=0) + 0.05 * draw.normal(size=(400, 16))
    vectors = np.concatenate([hot, pairs, draw.normal(size=(395, 16)), hot[:5]])
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)] + [(5000, [1.0, 2.0]), (5001, [2.0, 4.1]), (5002, [-1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in embedding_dedup.embedding_groups(table).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    linked = (unit @ unit.T >= 0.95) & ~np.eye(len(unit), dtype=bool)
    truth = linked.sum(axis=1)
    links = np.array([found[k].n_links for k in range(len(unit))])
    assert [(k, int(links[k]), int(truth[k])) for k in np.flatnonzero(links > truth)] == []
    assert links.sum() >= 0.99 * truth.sum()
    assert [found[k].component_id for k in range(400)] == [0] * 400
    assert [found[k].n_links for k in (5000, 5001, 5002)] == [1, 1, 0] and found[5001].component_id == 5000


def test_no_task_holds_more_than_a_block(spark, monkeypatch):
    sizes = []
    whole = embedding_dedup.written

    def count_first(df, name):
        result = whole(df, name)
        if name == "graphs":
            sizes.append(result.groupBy("dims", "shard").count().count())
        return result

    monkeypatch.setattr(embedding_dedup, "written", count_first)
    monkeypatch.setattr(embedding_dedup, "SHARD_BYTES", 20_000)
    vectors = np.random.default_rng(8).normal(size=(1000, 16))
    rows = [(k, k, k, 1, v.tolist()) for k, v in enumerate(vectors)]
    classes = spark.createDataFrame(rows, "h1 long, h2 long, node long, size long, vector array<double>")
    embedding_dedup.answers_of(classes, 0.95)
    # 384 bytes a node.
    assert sizes == [20]


def test_vectors_of_any_length_are_linked(spark):
    rows = [(1, [1e300, 1e300]), (2, [2e300, 2.1e300]), (3, [3e-200, 3e-200]), (4, [-1e-200, 1e-200]), (5, [5.0, 5.1])]
    found = embedding_dedup.embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == [(1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 0, 4), (5, 3, 1)]


@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.9, 0.95])
def test_recall_by_similarity(spark, similarity):
    """Pairs just above a similarity, each alone: no third text can join them."""
    draw, rows = np.random.default_rng(int(100 * similarity)), []
    for pair in range(150):
        words = [f"p{pair}w{k}" for k in range(400)]
        # A change takes five shingles from either side, if five words or more from the next.
        changes = int((1 - similarity) / (1 + similarity) * 396 / 5)
        copy = list(words)
        for at in draw.choice(78, changes, replace=False):
            copy[5 * int(at) + 5] = f"p{pair}x{at}"
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(copy))]
        a, b = (set(shingles(t).tolist()) for _, t in rows[-2:])
        assert similarity <= len(a & b) / len(a | b) < similarity + 0.03
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = {r.doc_id for r in keep_one(docs, similarity=0.8).collect()}
    found = sum(2 * k + 1 not in kept for k in range(150))
    print(f"recall at {similarity}: {found / 150:.3f}")
    assert found >= 148 and all(2 * k in kept for k in range(150))
