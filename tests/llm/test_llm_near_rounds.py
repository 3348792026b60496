"""What the pipeline's near-duplicate stage has on disk at once, and that it still finds all."""

import itertools
import os

import numpy as np
import pytest
from pyspark.sql.classic.dataframe import DataFrame

from tidemark.llm import shingle_dedup
from tidemark.llm.shingle_dedup import node_of, shingle_groups, shingles


def test_fingerprints_travel_by_rounds_and_not_again_to_shards_of_strangers(spark, monkeypatch):
    draw = np.random.default_rng(7)
    rows = [(k, " ".join(f"w{w}" for w in draw.integers(0, 5000, 60))) for k in range(400)]
    rows += [(400 + k, rows[k][1] + " end") for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sent, whole = [], DataFrame.mapInPandas
    monkeypatch.setattr(DataFrame, "mapInPandas", lambda self, *a, **b: (sent.append(self.count()), whole(self, *a, **b))[1])
    monkeypatch.setattr(shingle_dedup, "_ROUND", 14)
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    found = {r.node: r.root for r in shingle_groups(docs).collect()}
    nodes = {r.doc_id: r.node for r in docs.select("doc_id", node_of("text").alias("node")).collect()}
    assert found == {nodes[k + d]: min(nodes[k], nodes[k + 400]) for k in range(10) for d in (0, 400)}
    number = -(-len(shingle_dedup.draws(len(rows), 0.8)) // 14)
    # All draws are searched, a round at once; then only what may hold a pair that is not joined.
    assert number == 3 and len(sent) == 2 * number
    assert max(sent) < 0.5 * sum(sent[:number]) and sum(sent[number:]) < 0.1 * sum(sent[:number])
    left = {name.partition("-")[0] for name in set(os.listdir(shared)) - before}
    assert "sketches" in left and not left & {"keyed", "shared"}


@pytest.mark.parametrize("seed", range(40))
def test_a_shard_is_searched_again_if_it_may_hold_a_pair(seed):
    draw, near, far = np.random.default_rng(seed), 143, 201
    flip = lambda value, bits: value ^ sum(1 << int(b) for b in draw.choice(1024, bits, replace=False))
    values = [int.from_bytes(draw.bytes(128), "big") for _ in range(4)]
    if seed % 2:
        # A text within the wide radius of one that another stands for, not of the other.
        stands = flip(values[0], int(draw.integers(100, near + 1)))
        values += [stands, flip(stands, int(draw.integers(near, far + 1)))]
    shard, pairs = shingle_dedup._Shard(near, far), []
    for node, value in enumerate(values):
        pairs += shard.joined(node, value, True)
    assert shard.again == bool(seed % 2)
    assert all((values[a] ^ values[b]).bit_count() <= near for a, b in pairs)


def _crowd(number, seed=3):
    """Texts of one origin, most of them somewhat less alike than four fifths."""
    draw, rows = np.random.default_rng(seed), []
    words = [f"w{w}" for w in draw.integers(0, 3000, 200)]
    for k in range(number):
        copy = list(words)
        for at in draw.choice(len(copy), 3 + k % 2, replace=False):
            copy[at] = f"x{draw.integers(0, 1 << 30)}"
        rows.append((k, " ".join(copy)))
    return rows


@pytest.mark.parametrize("shard, held", [(2048, 4000), (16, 1 << 22)])
def test_a_crowd_of_texts_that_are_nearly_alike_costs_rows_not_pairs(spark, monkeypatch, shard, held):
    rows = _crowd(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(shingle_dedup, "_HELD", held, raising=False)
    made = []
    for name in ("mapInPandas", "mapInArrow"):
        whole = getattr(DataFrame, name)

        def counted(self, *a, whole=whole, **b):
            out = whole(self, *a, **b)
            if "home" in self.columns:
                made.append((self.count(), out.count()))
            return out

        monkeypatch.setattr(DataFrame, name, counted)
    found = {r.node: r.root for r in shingle_groups(docs, shard=shard).collect()}
    assert made and all(out <= came for came, out in made)
    sets = [(k, set(shingles(t).tolist())) for k, t in rows]
    near = [(a, b) for (a, s), (b, t) in itertools.combinations(sets, 2) if len(s & t) >= 0.8 * len(s | t)]
    nodes = {r.doc_id: r.node for r in docs.select("doc_id", node_of("text").alias("node")).collect()}
    roots = dict(nodes)
    for _ in rows:
        for a, b in near:
            roots[a] = roots[b] = min(roots[a], roots[b])
    assert {k: found.get(n, n) for k, n in nodes.items()} == roots
    assert near and len(set(roots.values())) > 20


@pytest.mark.parametrize("seed", range(10))
def test_pairs_that_leave_a_shard_are_alike_and_join_all_that_are(seed):
    draw = np.random.default_rng(seed)
    base = draw.choice(10_000, 40, replace=False)
    sets = [np.unique(np.append(draw.choice(base, 36, replace=False), draw.integers(10_000, 20_000, 2))) for _ in range(40)]
    values = [int.from_bytes(draw.bytes(16), "big") for _ in sets]
    # The first ten have come together before.
    root = [0] * 10 + list(range(10, 40))
    shard = shingle_dedup._Shard(1024, similarity=0.8)
    order = draw.permutation(40).tolist()
    out = [pair for k in order for pair in shard.apart(k, root[k], values[k], k % 5 > 0 or k < 10, sets[k])]
    alike = lambda a, b: len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))
    home = [k % 5 > 0 or k < 10 for k in range(40)]
    # A text looks at those that are at home and came before.
    seen = [(a, b) for at, a in enumerate(order) for b in order[:at] if home[b]]

    def grouped(pairs):
        roots = list(root)
        for _ in sets:
            for a, b in pairs:
                low = min(roots[a], roots[b])
                roots = [low if r in (roots[a], roots[b]) else r for r in roots]
        return roots

    assert all(alike(a, b) for a, b in out)
    assert grouped(out) == grouped([p for p in seen if alike(*p)]) and len(out) == len(set(root)) - len(set(grouped(out)))
    assert len(set(grouped(out))) > 1
