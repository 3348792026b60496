"""Op 2: near-duplicate vectors by HNSW graphs, one for each shard.

Equal vectors are one node. Nodes are dealt out over shards; each shard builds its graph, widens
its beam until an audit against brute force passes, and is written to the shared folder. Every
shard is then asked for every node of the table, a block of nodes at a time: a task holds one graph
and one block. What a graph finds is verified by the cosine in double precision, counted, and
joined to components.
"""

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.hnsw import Graph
from tidemark.llm.shipping import ship
from tidemark.llm.storage import written

#: At least so many shards, and about so many bytes of vectors and links in one.
SHARDS = 8
SHARD_BYTES = 128 << 20

#: At least so many blocks of queries, and about so many bytes of vectors in one.
BLOCKS = 4
BLOCK_BYTES = 32 << 20

#: Bytes of a written graph in one row.
_CHUNK = 4 << 20

#: Queries of an audit by node and by group, and the share of its true links that a query has to
#: find in the mean of either.
AUDIT = 256
RECALL = 0.995

#: Slack of single-precision similarities before a pair is verified.
_SLACK = 1e-4


class Shard:
    """The graph of a shard and the beam that its audit asks for."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, sizes: np.ndarray, least: float, seed: int):
        self._hold(ids, vectors, sizes, least)
        self._unit = vectors / self._norms[:, None]
        self._graph = Graph(self._unit, seed)
        self.width = 32
        self._audit(seed)

    def _hold(self, ids: np.ndarray, vectors: np.ndarray, sizes: np.ndarray, least: float) -> None:
        self.ids, self._vectors, self._sizes, self._least = ids, vectors, sizes, least
        self._norms = np.linalg.norm(vectors, axis=1)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        own = {"ids": self.ids, "vectors": self._vectors, "sizes": self._sizes, "width": np.array(self.width)}
        np.savez(out, **own, **self._graph.arrays())
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes, least: float) -> "Shard":
        """The shard that was written, ready to answer."""
        with np.load(io.BytesIO(data), allow_pickle=False) as stored:
            arrays = dict(stored)
        shard = cls.__new__(cls)
        shard._hold(arrays.pop("ids"), arrays.pop("vectors"), arrays.pop("sizes"), least)
        shard.width = int(arrays.pop("width"))
        shard._graph = Graph.of(shard._vectors / shard._norms[:, None], arrays)
        return shard

    def _audit(self, seed: int) -> None:
        """Ask for vectors as far from some node as a link may be, where a search is hardest."""
        draw = np.random.default_rng(seed)
        some = draw.permutation(len(self.ids))[: 4 * AUDIT]
        near = np.concatenate([self._alike(self._unit[some[k : k + 64]]).sum(axis=1) for k in range(0, len(some), 64)])
        # As many again by group: a node counts the less, the more nodes it links with.
        share = 1 / np.maximum(near, 1)
        grouped = draw.choice(len(some), min(AUDIT, len(some)), replace=False, p=share / share.sum())
        base = self._unit[np.concatenate([some[:AUDIT], some[grouped]])]
        by_node = np.arange(len(base)) < min(AUDIT, len(some))
        aside = draw.normal(size=base.shape)
        aside -= (aside * base).sum(axis=1, keepdims=True) * base
        aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-12)
        level = self._least + 1e-3
        asked = level * base + np.sqrt(1 - level**2) * aside
        truth = np.concatenate([self._alike(asked[k : k + 64]) for k in range(0, len(asked), 64)])
        total = truth.sum(axis=1)
        # Each query counts as one, whatever the number of its links.
        drawn = [d & (total > 0) for d in (by_node, ~by_node)]
        while self.width < len(self.ids):
            found = self._graph.within(asked, self._least, self.width)
            recall = np.array([truth[k, f].sum() for k, f in enumerate(found)]) / np.maximum(total, 1)
            if all(recall[d].mean() >= RECALL for d in drawn if d.any()):
                break
            self.width *= 2

    def _alike(self, asked: np.ndarray) -> np.ndarray:
        return asked @ self._unit.T >= self._least

    def links(self, ids: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """For each query its number, how many vectors it links with, and the linked nodes."""
        norms = np.linalg.norm(vectors, axis=1)
        found = self._graph.within(vectors / norms[:, None], self._least - _SLACK, self.width)
        for k, near in enumerate(found):
            near = near[self.ids[near] != ids[k]]
            if len(near):
                cosine = (self._vectors[near] @ vectors[k]) / (self._norms[near] * norms[k])
                near = near[cosine >= self._least]
            if len(near):
                yield k, int(self._sizes[near].sum()), near


def _parts(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, bool, pa.RecordBatch]]:
    """The rows of each key, in portions, and whether a portion is the first of its key."""
    last = None
    for batch in batches:
        key = np.stack([batch.column(k).to_numpy() for k in keys])
        edges = [0, *(np.flatnonzero((np.diff(key) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            if low == high:
                continue
            own = tuple(key[:, low].tolist())
            yield own, own != last, batch.slice(low, high - low)
            last = own


def _nodes(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, vectors and sizes of a portion, whose vectors are of one length.

    Vectors are scaled by powers of two, which changes no cosine, so that no norm leaves the
    range of doubles.
    """
    vectors = part.column("vector").flatten().to_numpy().astype(float).reshape(len(part), -1)
    vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
    return part.column("node").to_numpy(), vectors, part.column("size").to_numpy()


def _graphs(least: float):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunks(key, nodes):
            data = Shard(*map(np.concatenate, zip(*nodes)), least, key[1]).to_bytes()
            for chunk, start in enumerate(range(0, len(data), _CHUNK)):
                yield pa.RecordBatch.from_pydict(
                    {"dims": [key[0]], "shard": [key[1]], "chunk": [chunk], "data": [data[start : start + _CHUNK]]},
                    schema=pa.schema([("dims", pa.int32()), ("shard", pa.int32()), ("chunk", pa.int32()), ("data", pa.binary())]),
                )

        last, nodes = None, []
        for key, first, part in _parts(batches, ["dims", "shard"]):
            if first and nodes:
                yield from chunks(last, nodes)
                nodes = []
            last = key
            nodes.append(_nodes(part))
        if nodes:
            yield from chunks(last, nodes)

    return build


def _answers(least: float):
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunks, parent = None, [], {}

        def find(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for _, first, part in _parts(batches, ["dims", "shard", "block"]):
            if first:
                shard, chunks, parent = None, [], {}
            # The graph comes first.
            cut = len(part) - part.column("chunk").null_count
            chunks += part.column("data").slice(0, cut).to_pylist()
            if cut == len(part) or not (shard or chunks):
                continue
            if shard is None:
                shard, chunks = Shard.from_bytes(b"".join(chunks), least), []
            ids, vectors, _ = _nodes(part.slice(cut))
            a, b, w = [], [], []
            for k, count, near in shard.links(ids, vectors):
                me = int(ids[k])
                a.append(me), b.append(None), w.append(count)
                for other in map(int, shard.ids[near]):
                    mine, theirs = find(me), find(other)
                    if mine != theirs:
                        parent[mine] = theirs
                        a.append(me), b.append(other), w.append(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(w, pa.int64())], ["a", "b", "w"]
            )

    return answer


def _numbers(n: int, column: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(column)


def answers_of(classes: DataFrame, least: float) -> DataFrame:
    """``a, b, w`` for ``h1, h2, node, size, vector``: per shard, node and with ``b`` null the
    vectors that the node links with there, and the links that join two groups of a task's own."""
    sizes = classes.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    n, dims = sizes
    shards = max(SHARDS, -(-n * (8 * dims + 256) // SHARD_BYTES))
    blocks = max(BLOCKS, -(-n * 8 * dims // BLOCK_BYTES))
    nodes = classes.select(
        F.size("vector").alias("dims"),
        F.pmod(F.xxhash64("h1", "h2"), F.lit(shards)).cast("int").alias("shard"),
        F.pmod(F.xxhash64("h2", "h1"), F.lit(blocks)).cast("int").alias("block"),
        "node", "size", "vector",
    )
    # One number, one partition: hashed, several would meet in one task.
    own = nodes.drop("block").repartitionById(shards, F.pmod(F.col("shard") + F.hash("dims"), F.lit(shards)))
    built = own.sortWithinPartitions("dims", "shard", "node").mapInArrow(
        _graphs(least), "dims int, shard int, chunk int, data binary"
    )
    graphs = written(built, "graphs")
    queries = nodes.drop("shard").select("*", _numbers(shards, "shard"))
    copies = graphs.select("*", _numbers(blocks, "block"))
    tasks = shards * blocks
    number = F.pmod(F.col("shard").cast("long") * blocks + F.col("block") + F.hash("dims"), F.lit(tasks)).cast("int")
    dealt = copies.unionByName(queries, allowMissingColumns=True).repartitionById(tasks, number)
    ordered = dealt.sortWithinPartitions("dims", "shard", "block", F.asc_nulls_last("chunk"), "node")
    return written(ordered.mapInArrow(_answers(least), "a long, b long, w long"), "answers")


def embedding_groups(
    rows: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``id_col, n_links, component_id, kept`` for every row.

    Two vectors are linked if their cosine in double precision is ``least`` or more. A graph
    may miss links (audited share: ``RECALL``); none is reported below ``least``. Vectors that
    are null, zero, or hold null or non-finite components link with nothing, as do vectors of
    different lengths. ``component_id`` is the smallest id that links lead to.

    Rows that repeat a vector are copies, and linked. Rows without an id link with nothing and
    have no component. One id with several vectors is one node of the components. Other
    columns are not read; an empty table gives no rows.

    Every node is sent to every shard and every graph to every block of nodes: a task answers one
    block for one shard, each of bounded bytes, so tasks do not grow with the table but their
    number does, with its square. Of the links only counts and, for each task, those that join
    two groups leave it.
    """
    ship(rows.sparkSession)
    vector = F.col(vector_col)
    sound = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = sound & F.exists(vector, lambda x: x != 0) & F.col(id_col).isNotNull()
    keyed = rows.select(
        F.col(id_col).alias("id"),
        F.when(F.coalesce(sound, F.lit(False)), vector).alias("vector"),
    ).select("id", "vector", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"))
    classes = written(
        keyed.where("vector is not null")
        .groupBy("h1", "h2")
        .agg(F.min("id").cast("long").alias("node"), F.count(F.lit(1)).alias("size"), F.any_value("vector").alias("vector")),
        "vectors",
    )
    answers = answers_of(classes, least)
    counts = answers.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("w"))
    roots = components(answers.where("b is not null").select("a", "b"))
    named = (
        classes.select("h1", "h2", "node", "size")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .select(
            "h1",
            "h2",
            (F.coalesce("w", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("component_id"),
        )
    )
    joined = keyed.withColumn("sound", F.col("vector").isNotNull()).select("id", "sound", "h1", "h2").join(
        named, ["h1", "h2"], "left"
    )
    root = F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("id").cast("long"))
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("sound"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        root.alias("component_id"),
        F.coalesce(root == F.col("id"), F.lit(False)).alias("kept"),
    )
