"""Connected components of links that are never brought together in one place."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import written


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a``, ``b``), ``root`` being the
    smallest node it is connected with; nodes without links do not appear.

    Alternates large-star and small-star steps until nothing changes. Each step hangs nodes
    under the smallest neighbour, so the number of links never grows, and is an aggregate
    (one row per node and task before the shuffle) and an equi join on the node. The links of
    each round are a table in the shared folder.
    """
    links = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = _state(links)
    while state[0]:
        links = written(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if before == state:
            break
    roots = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(links: DataFrame) -> tuple:
    found = links.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
    )
    return tuple(found.first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung under the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    # A table of its own: beside an aggregate Spark does not split the partition of a node
    # with many neighbours.
    least = written(least.select(F.col("a").alias("n"), F.least("a", "m").alias("m")), "least")
    joined = both.join(least, both["a"] == least["n"]).where("b > a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are hung under the smallest one."""
    least = written(links.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")), "least")
    moved = links.join(least, F.col("a") == F.col("n")).where("b <> m")
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
        .distinct()
    )
