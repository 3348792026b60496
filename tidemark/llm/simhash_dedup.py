"""Op 7: near-duplicates by SimHash fingerprints, found with BK-trees.

Two fingerprints that differ in at most two of 64 bits agree in at least two of four 16-bit
blocks. So a fingerprint belongs to six shards, one for each pair of blocks, and every link
lies within some shard. A shard is a BK-tree: the children of a node are keyed by their
Hamming distance to it, and a search follows only the edges within the radius of its own
distance (triangle inequality), so it finds all that is within the radius.

The trees are not broadcast from the driver, which would have to hold all fingerprints: each is
built by the task that searches it. A shard larger than ``SHARD`` is dealt out over several
trees, and its fingerprints are sent to each of them.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bk_tree import BKTree
from tidemark.llm.components import components
from tidemark.llm.shingle_dedup import node_of, shingle_groups
from tidemark.llm.shipping import ship
from tidemark.llm.storage import written

RADIUS = 2

#: Nodes of one tree.
SHARD = 4096

#: Shingle hashes whose bits are counted at once.
_BLOCK = 1 << 15

#: The bits two fingerprints have to agree in, one mask for each pair of 16-bit blocks.
_MASKS = [
    (0xFFFF << 16 * a) | (0xFFFF << 16 * b) for a in range(4) for b in range(a + 1, 4)
]


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a whole text: bit ``k`` is set if it is in over half of the shingles' hashes.

    ASCII letters are lower-cased, words are what is between ASCII white space, shingles are
    joined by one space and hashed by XXH64 with seed 42. A text with fewer words is one
    shingle; without words the fingerprint is 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    stops = ends[size - 1 :].tolist()
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, len(starts), _BLOCK):
        hashes = np.array(
            [digest(line[s:e], 42) for s, e in zip(starts[k : k + _BLOCK], stops[k : k + _BLOCK])],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id_col, fingerprint`` (64 bits as a signed long) for every row of ``docs``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array(
                [fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64
            ).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["id", "fingerprint"])

    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(compute, f"id {kind}, fingerprint long").withColumnRenamed("id", id_col)


def fingerprint_links(values: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints within ``radius`` (2 at most) of each other.

    ``values`` holds distinct fingerprints. Within a tree a fingerprint is linked only where
    that joins two groups: no more links than fingerprints, and the same components.
    """
    if not 0 <= radius <= 2:
        raise ValueError("pairs of four blocks find links of up to 2 bits")
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in _MASKS])
    keyed = values.select(F.col("fingerprint"), F.posexplode(masks).alias("pair", "mask"))
    keyed = keyed.select("pair", F.expr("fingerprint & mask").alias("key"), "fingerprint")
    shared = keyed.groupBy("pair", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    trees = F.ceil(F.col("n") / F.lit(shard)).cast("int")
    rows = keyed.join(shared.withColumn("trees", trees).drop("n"), ["pair", "key"]).select(
        "pair",
        "key",
        "fingerprint",
        F.pmod(F.xxhash64("fingerprint"), F.col("trees")).cast("int").alias("home"),
        F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree"),
    )
    # A fingerprint looks into its own tree and, of two trees, the one with the lower number.
    dealt = (
        rows.where("tree <= home")
        .repartition("pair", "key", "tree")
        .sortWithinPartitions("pair", "key", "tree", F.desc(F.expr("home = tree")), "fingerprint")
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, tree, parent = None, None, {}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            out = []
            columns = (batch[c].tolist() for c in ("pair", "key", "tree", "home", "fingerprint"))
            for pair, key, number, home, value in zip(*columns):
                if (pair, key, number) != group:
                    group, tree, parent = (pair, key, number), BKTree(), {}
                bits = value & 0xFFFFFFFFFFFFFFFF
                parent.setdefault(value, value)
                for other in tree.within(bits, radius):
                    other = other - (1 << 64) if other >> 63 else other
                    mine, theirs = find(value), find(other)
                    if mine != theirs:
                        parent[mine] = theirs
                        out.append((value, other))
                if home == number:
                    tree.add(bits)
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    ship(values.sparkSession)
    return dealt.mapInPandas(search, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``id_col, fingerprint, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id that links of at most ``radius`` bits lead to, the
    row's own included. Links are sought between distinct fingerprints, so copies cost one
    row each. Null texts have no words and fingerprint 0, which links like any other. Null
    ids are ignored as component ids unless a component has no other; repeated rows stay;
    other columns are not read; an empty table gives no rows.
    """
    marked = written(fingerprints(docs, id_col, text_col).withColumnRenamed(id_col, "_id"), "fingerprints")
    values = written(marked.groupBy("fingerprint").agg(F.min("_id").alias("_least")), "values")
    found = components(fingerprint_links(values, radius))
    rooted = values.join(found, values["fingerprint"] == found["node"], "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("_root")
    )
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = rooted.join(least, "_root").select("fingerprint", "component_id")
    joined = marked.join(named, "fingerprint")
    return joined.select(F.col("_id").alias(id_col), "fingerprint", "component_id")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float | None = None
) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest id; columns stay.

    Components are those of the fingerprints or, with a ``similarity``, of texts that wider
    fingerprints find and whose sets of five-word shingles have at least that Jaccard similarity
    (:mod:`shingle_dedup`).

    The row is chosen by id and text, so where one id stands for different texts each component
    still keeps a row. Of rows that repeat both one stays. A row without an id cannot be named:
    such rows stay, once for each text. Texts go by a 64-bit hash among the links; where a second
    hash tells two of one number apart, both stay.
    """
    check = F.xxhash64(F.lit(1), F.coalesce(F.col(text_col), F.lit("")))
    texts = docs.select(F.col(id_col).alias("_id"), node_of(text_col).alias("node"), check.alias("check"))
    one = F.min("check") == F.max("check")
    least = written(texts.groupBy("node").agg(F.min("_id").alias("_least"), one.alias("one")), "least")
    shared = written(least.where(~F.col("one")).select(F.col("node").alias("_shared")), "shared")
    least = least.drop("one")
    if similarity is None:
        copies = docs.select(node_of(text_col).alias("node"), F.col(text_col).alias("text"))
        groups = simhash_groups(copies, "node", "text").select("node", F.col("component_id").alias("root")).distinct()
    else:
        groups = shingle_groups(docs, text_col, similarity)
    rooted = least.where("_least is not null").join(groups, "node", "left")
    first = F.min(F.struct("_least", "node")).alias("first")
    named = rooted.groupBy(F.coalesce("root", "node").alias("root")).agg(first)
    named = named.select(F.col("first._least").alias("_keep"), F.col("first.node").alias("_node"))
    marked = docs.withColumn("_text_node", node_of(text_col))
    chosen = (marked[id_col] == named["_keep"]) & (marked["_text_node"] == named["_node"])
    alone = F.col("_text_node") == F.col("_shared")
    kept = marked.join(named, chosen, "left_semi").join(shared, alone, "left_anti")
    kept = kept.dropDuplicates([id_col, "_text_node"]).drop("_text_node")
    # Texts that share a number with another one, of which there are next to none.
    number = F.row_number().over(Window.partitionBy("_text_node", "_text_check").orderBy(id_col)).alias("_rank")
    apart = marked.where(F.col(id_col).isNotNull()).join(shared, alone, "left_semi").withColumn("_text_check", check)
    kept = kept.unionByName(apart.select("*", number).where("_rank = 1").select(*docs.columns))
    nameless = docs.where(F.col(id_col).isNull()).dropDuplicates([text_col])
    return kept.unionByName(nameless)
