"""Near-duplicates by SimHash fingerprints and BK-trees, verified by the exact Jaccard similarity.

Two texts at a similarity of 0.8 differ in 15 % of their SimHash bits, give or take. In 64 bits
that cannot be told from less alike texts and no few blocks agree, so the fingerprints are those of
operator 7 made wider: ``BITS`` bits over the distinct five-word shingles. A shard is a draw of bits
in which fingerprints agree, as operator 7's shards are pairs of blocks; there are as many draws as
let two texts at the similarity share one with a probability of ``RECALL``, and a draw has a few
bits more than the number of texts, so that a shard holds few that are not alike. Within a shard a
BK-tree finds what lies within the radius, and every link is verified by whole shingle sets.

Shards are searched twice. The first time pairs that look alike are offered where they join two
groups of their shard, so that a large group costs a pair a text; the second time all pairs that
the verified links of the first have not brought together, in a radius of four standard errors more.
Most shards hold texts that met by chance: the first search names those that can hold a link of the
second, and the others are not searched again.

Of many texts that are nearly alike the pairs of the second search grow with the square of their
number. So it names, for each shard, the texts that are in some pair; these texts meet once more
with their sets, where a pair is verified as it is found, and only pairs that join two groups leave
the task.

Both searches go by rounds of ``_ROUND`` draws, each of which frees what it has written and
shuffled; fingerprints travel last, once a search, to the trees.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bk_tree import BKTree
from tidemark.llm.components import components
from tidemark.llm.shipping import ship
from tidemark.llm.storage import freed, written

SHINGLE = 5
SIMILARITY = 0.8

#: Bits of a fingerprint, a multiple of 64.
BITS = 1024

#: The share of pairs just at the similarity that are to meet in some shard.
RECALL = 0.998

#: Bits of a draw beyond those that number the texts.
_SPARE = 2

#: Draws whose shards are looked for and searched at once; what is shuffled for them is freed
#: before the next.
_ROUND = 32

#: Texts that are compared with each other in one task.
SHARD = 2048

#: Shingle hashes whose texts are compared with each other in one task.
_HELD = 1 << 22

#: Standard errors by which a distance may be too large and the pair still be verified.
_SLACK = 4

#: Shingle hashes whose bits are counted at once; a byte holds the counts.
_BLOCK = 255


def node_of(text_col: str) -> Column:
    """The number a text goes by; null is the empty text."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the runs of ``shingle`` words, as :func:`simhash_dedup.fingerprint`
    cuts them. A text with fewer words is one shingle, one without words the empty shingle."""
    words = (text or "").encode().lower().split()
    size = max(1, min(shingle, len(words)))
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words] or [1]) - 1
    starts = [0, *(ends[: len(ends) - size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[s:e], 42) for s, e in zip(starts, ends[size - 1 :].tolist())], dtype=np.uint64))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """SimHash of distinct shingle hashes: bit ``k`` is set if it is in over half of them.

    Each hash is mixed (as SplitMix64 does) into ``BITS`` bits; ``BITS / 8`` bytes."""
    steps = np.arange(1, BITS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), _BLOCK):
        mixed = hashes[k : k + _BLOCK, None] + steps
        mixed = (mixed ^ mixed >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ mixed >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        mixed = (mixed ^ mixed >> np.uint64(31)).astype("<u8")
        ones += np.unpackbits(mixed.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(hashes))


def expected_distance(similarity: float) -> float:
    """The share of bits in which two texts of one length differ at a Jaccard similarity.

    It is their sets' angle over pi; texts of two lengths differ in fewer."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def draws(n: int, similarity: float) -> np.ndarray:
    """The bits of each draw, one row for a draw, for ``n`` texts."""
    size = min(40, int(np.ceil(np.log2(max(n, 2)))) + _SPARE)
    agree = (1 - expected_distance(similarity)) ** size
    number = 1 if agree >= RECALL else int(np.ceil(np.log(1 - RECALL) / np.log(1 - agree)))
    draw = np.random.default_rng(42)
    return np.array([draw.permutation(BITS)[:size] for _ in range(number)])


def _sketches(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """``node, sketch`` for every text: its wide fingerprint."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = [wide_fingerprint(shingles(t.as_py(), shingle)).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sketches, pa.binary())], ["node", "sketch"])

    rows = docs.select(node_of(text_col).alias("node"), F.col(text_col).alias("text"))
    return rows.mapInArrow(compute, "node long, sketch binary").dropDuplicates(["node"])


def _keyed(sketches: DataFrame, bits: np.ndarray, first: int) -> DataFrame:
    """``key, node`` for every text and draw: the draw's number, counted from ``first``, and its bits."""
    numbers = np.arange(first, first + len(bits), dtype=np.int64)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(b"".join(s.as_py() for s in batch.column(1)), dtype=np.uint8)
            ones = np.unpackbits(raw.reshape(-1, BITS // 8), axis=1)
            keys = np.tile(numbers, (len(ones), 1))
            for k in range(bits.shape[1]):
                keys = keys << 1 | ones[:, bits[:, k]]
            offsets = pa.array(np.arange(0, keys.size + 1, len(numbers), dtype=np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["node", "keys"])

    return sketches.mapInArrow(compute, "node long, keys array<long>").select(F.explode("keys").alias("key"), "node")


def _shards(sketches: DataFrame, bits: np.ndarray, first: int = 0) -> DataFrame:
    """``key, node, n`` of the draws ``bits``, but for the texts that are alone with their key;
    ``n`` is the number of texts with the key."""
    keyed = _keyed(sketches, bits, first)
    # A table of its own: beside an aggregate Spark does not split the rows of a hot key.
    shared = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    found = written(keyed.join(shared, "key"), "keyed")
    freed(shared)
    return found


def _sets(docs: DataFrame, nodes: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """``node, hashes`` for those texts of ``docs`` that are in ``nodes``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), shingle).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "hashes"])

    rows = docs.select(node_of(text_col).alias("node"), F.col(text_col).alias("text"))
    return rows.join(nodes, "node", "left_semi").mapInArrow(compute, "node long, hashes array<long>").dropDuplicates(["node"])


def _alike(one: np.ndarray, other: np.ndarray, similarity: float) -> bool:
    """Whether two sets of shingles have a Jaccard similarity of ``similarity`` or more."""
    few, many = sorted((len(one), len(other)))
    if few / many < similarity:
        return False
    both = len(np.intersect1d(one, other, assume_unique=True))
    # The quotient of two whole numbers, so that exactly 0.8 is 0.8.
    return both / (few + many - both) >= similarity


class _Shard:
    """The texts of one shard that are at home in one tree."""

    def __init__(self, radius: int, far: int = 0, similarity: float | None = None):
        self._radius, self._far, self._similarity = radius, far, similarity
        #: Whether two texts that came to :meth:`joined` may lie within ``far``.
        self.again = False
        self._trees: dict[int | None, BKTree] = {}
        self._nodes: dict[int | None, dict[int, list[int]]] = {}
        self._groups: dict[int, int] = {}
        self._sets: dict[int, np.ndarray] = {}
        self._told: set[int] = set()

    def _group(self, node: int) -> int:
        groups = self._groups
        while node in groups:
            above = groups[node]
            groups[node] = node = groups.get(above, above)
        return node

    def joined(self, node: int, value: int, home: bool) -> Iterator[tuple[int, int]]:
        """Links with texts within the radius, where they join two groups.

        One that is within the radius of another need not be found itself: the other stands for it."""
        tree, nodes = self._trees.setdefault(None, BKTree()), self._nodes.setdefault(None, {})
        # Who is within ``far`` of a text that another stands for is within both radii of the other.
        around = tree.within(value, self._radius + self._far)
        self.again = self.again or bool(around)
        found = [near for near in around if (near ^ value).bit_count() <= self._radius]
        for near in found:
            mine, theirs = self._group(node), self._group(nodes[near][0])
            if mine != theirs:
                self._groups[mine] = theirs
                yield node, nodes[near][0]
        if home and not found:
            tree.add(value)
            nodes[value] = [node]

    def apart(
        self, node: int, root: int, value: int, home: bool, hashes: np.ndarray | None = None
    ) -> Iterator[tuple[int, int]]:
        """All texts within the radius that are of other roots; where texts come with their sets,
        those that are alike by these, as far as they join two groups."""
        # A tree for each group that is joined already, which its own texts need not search, and
        # one for all others.
        own = root if root != node else None
        for other, tree in self._trees.items():
            if other is not None and self._group(other) == self._group(root):
                continue
            for near in tree.within(value, self._radius):
                for n in self._nodes[other][near]:
                    mine, theirs = self._group(root), self._group(n if other is None else other)
                    if mine == theirs:
                        continue
                    if hashes is not None:
                        if not _alike(hashes, self._sets[n], self._similarity):
                            continue
                        self._groups[mine] = theirs
                    yield node, n
        if home:
            self._trees.setdefault(own, BKTree()).add(value)
            self._nodes.setdefault(own, {}).setdefault(value, []).append(node)
            if hashes is not None:
                # A copy, so that it does not hold its batch.
                self._sets[node] = hashes.copy()

    def ends(self, node: int, root: int, value: int, home: bool) -> Iterator[int]:
        """The texts of the pairs that :meth:`apart` finds, each once."""
        for pair in self.apart(node, root, value, home):
            for end in pair:
                if end not in self._told:
                    self._told.add(end)
                    yield end


def _unjoined(rows: DataFrame) -> DataFrame:
    """Those ``rows`` whose key is that of several roots."""
    roots = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    # A table of its own: beside an aggregate Spark does not split the rows of a hot key.
    return rows.join(written(roots.where("low <> high").select("key"), "unjoined"), "key", "left_semi")


def _dealt(rows: DataFrame, shard: int, texts: DataFrame | None, *columns: str) -> DataFrame:
    """``key, tree, home, node, root`` and ``columns``, in the order in which trees are searched.

    ``rows``: ``key, node, n, root``, and ``columns`` unless ``texts`` has them by node. A key with
    more than ``shard`` nodes is dealt out over several trees, and its nodes are sent to each of them.
    """
    home = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / F.lit(shard)).cast("int")).cast("int")
    dealt = rows.withColumn("home", home).withColumn("tree", F.explode(F.sequence(F.lit(0), F.col("home"))))
    if texts is not None:
        dealt = dealt.join(texts, "node")
    dealt = dealt.select("key", "tree", "home", "node", "root", *columns).repartition("key", "tree")
    return dealt.sortWithinPartitions("key", "tree", F.desc(F.expr("home = tree")), "node")


def _searched(
    rows: DataFrame, radius: int, forest: bool, shard: int, sketches: DataFrame | None = None, far: int = 0
) -> DataFrame:
    """``a, b, key``: pairs of nodes that share a key and lie within the radius, with -1 for a key;
    in a forest also the keys, 0 and up, whose shards may hold a pair within ``far``.

    ``rows``, ``shard`` and ``sketches`` are those of :func:`_dealt`, for ``sketch``.
    """
    dealt = _dealt(rows, shard, sketches, "sketch")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held = None, None
        for batch in batches:
            out = []
            columns = (batch[c].tolist() for c in ("key", "tree", "home", "node", "root", "sketch"))
            for key, tree, own, node, root, sketch in zip(*columns):
                if (key, tree) != group:
                    group, held = (key, tree), _Shard(radius, far)
                value = int.from_bytes(sketch, "big")
                if forest:
                    told = held.again
                    out.extend((a, b, -1) for a, b in held.joined(node, value, own == tree))
                    if held.again and not told:
                        out.append((0, 0, key))
                else:
                    out.extend((a, b, -1) for a, b in held.apart(node, root, value, own == tree))
            yield pd.DataFrame(out, columns=["a", "b", "key"], dtype="int64")

    return dealt.mapInPandas(search, "a long, b long, key long")


def _ends(rows: DataFrame, radius: int, shard: int, sketches: DataFrame) -> DataFrame:
    """``key, node``: the nodes that share a key with one of another root within the radius.

    ``rows``, ``shard`` and ``sketches`` are those of :func:`_dealt`, for ``sketch``.
    """
    dealt = _dealt(rows, shard, sketches, "sketch")

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held = None, None
        for batch in batches:
            out = []
            columns = (batch[c].tolist() for c in ("key", "tree", "home", "node", "root", "sketch"))
            for key, tree, own, node, root, sketch in zip(*columns):
                if (key, tree) != group:
                    group, held = (key, tree), _Shard(radius)
                out.extend((key, end) for end in held.ends(node, root, int.from_bytes(sketch, "big"), own == tree))
            yield pd.DataFrame(out, columns=["key", "node"], dtype="int64")

    return dealt.mapInPandas(meet, "key long, node long").distinct()


def _pairs(found: DataFrame) -> DataFrame:
    """The distinct pairs ``a < b`` of what was found."""
    return found.where("key < 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _candidates(rows: DataFrame, radius: int, forest: bool, shard: int, sketches: DataFrame | None = None) -> DataFrame:
    """Pairs ``a < b`` of nodes that share a key, are of different roots and lie within the radius.

    ``rows`` are those of :func:`_searched`; in a forest every node is its own root.
    """
    return _pairs(_searched(rows if forest else _unjoined(rows), radius, forest, shard, sketches))


def _linked(rows: DataFrame, texts: DataFrame, radius: int, similarity: float, shard: int) -> DataFrame:
    """``a, b``: of the nodes that share a key, are of different roots and lie within the radius,
    pairs at the ``similarity`` or more, no more than join the groups of a tree.

    ``rows``: ``key, node, root``; ``texts``: ``node, sketch, hashes``. A tree has no more than
    ``shard`` texts and, as many, about ``_HELD`` hashes.
    """
    sizes = rows.join(texts.select("node", F.size("hashes").alias("size")), "node").groupBy("key")
    sizes = sizes.agg(F.count(F.lit(1)).alias("texts"), F.sum("size").alias("held"))
    trees = F.greatest(F.col("texts"), F.ceil(F.col("held") * F.lit(shard / _HELD)))
    # A table of its own: beside an aggregate Spark does not split the rows of a hot key.
    sized = rows.join(written(sizes.select("key", trees.alias("n")), "sizes"), "key")
    dealt = _dealt(sized, shard, texts, "sketch", "hashes")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, None
        for batch in batches:
            out, sets = [], batch.column("hashes")
            columns = (batch.column(c).to_pylist() for c in ("key", "tree", "home", "node", "root", "sketch"))
            for at, (key, tree, own, node, root, sketch) in enumerate(zip(*columns)):
                if (key, tree) != group:
                    group, held = (key, tree), _Shard(radius, similarity=similarity)
                value = int.from_bytes(sketch, "big")
                out.extend(held.apart(node, root, value, own == tree, sets[at].values.to_numpy()))
            ends = ([pair[k] for pair in out] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], ["a", "b"])

    return dealt.mapInArrow(verify, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, similarity: float, text_col: str, shingle: int) -> DataFrame:
    """The pairs whose shingle sets have a Jaccard similarity of ``similarity`` or more."""
    nodes = written(pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node"), "nodes")
    sets = written(_sets(docs, nodes, text_col, shingle), "sets")
    left, right = (sets.select(F.col("node").alias(c), F.col("hashes").alias(f"h{c}")) for c in "ab")
    both = F.size(F.array_intersect("ha", "hb"))
    # The quotient of two whole numbers, as in _alike.
    return pairs.join(left, "a").join(right, "b").where(both / (F.size("ha") + F.size("hb") - both) >= similarity).select("a", "b")


def shingle_groups(
    docs: DataFrame, text_col: str = "text", similarity: float = SIMILARITY, shingle: int = SHINGLE, shard: int = SHARD
) -> DataFrame:
    """``node, root`` for every text (:func:`node_of`) that is linked with another one.

    Two texts are linked if the sets of their shingles have a Jaccard similarity of
    ``similarity`` or more; ``root`` is the smallest node that links lead to. No pair below is
    linked; of pairs just at ``similarity`` some 2 in 1,000 share no shard, of others fewer.
    """
    ship(docs.sparkSession)
    sketches = written(_sketches(docs, text_col, shingle), "sketches")
    share = expected_distance(similarity)
    error = float(np.sqrt(share * (1 - share) * BITS))
    near, far = int(share * BITS - error), int(np.ceil(share * BITS + _SLACK * error))
    drawn = draws(sketches.count(), similarity)
    found, again = [], []
    for k in range(0, len(drawn), _ROUND):
        rows = _shards(sketches, drawn[k : k + _ROUND], k)
        found.append(written(_searched(rows.withColumn("root", F.col("node")), near, True, shard, sketches, far), "found"))
        keys = found[-1].where("key >= 0").select("key")
        again.append(written(rows.join(keys, "key", "left_semi"), "again"))
        freed(rows)
    first = written(_pairs(_all(found)), "pairs")
    links = written(_verified(first, docs, similarity, text_col, shingle), "verified")
    roots = components(links)
    # Texts that no shard can link are out, so that no round shuffles their fingerprints.
    left = sketches.join(_all(again).select("node").distinct(), "node", "left_semi")
    sketches, rest = written(left, "sketches"), []
    for rows in again:
        rooted = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        rest.append(written(_ends(_unjoined(rooted), far, shard, sketches), "rest"))
    nodes = written(_all(rest).select("node").distinct(), "nodes")
    texts = written(sketches.join(_sets(docs, nodes, text_col, shingle), "node"), "texts")
    rooted = _all(rest).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return components(links.unionByName(written(_linked(rooted, texts, far, similarity, shard), "more")))


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
