"""Connected components of an edge table by alternating large and small stars.

Each round is two joins with a minimum per node; the least neighbour comes
from a partial aggregate, so a node with very many edges meets in no task.
Rounds grow with the logarithm of the longest path. Every round is written to
the shared folder; the driver sees only its count and checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import workers


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of u to u's least neighbour (u itself included)."""
    both = _both(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Join every smaller neighbour of u, and u, to the least of them. Edges run from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an undirected edge table; root is the least node reachable.

    Loops and repeated edges are allowed; edges with a null end are left out;
    an empty table gives an empty result.
    """
    one, two = F.col(a).cast("long"), F.col(b).cast("long")
    now = workers.keep(edges.select(F.greatest(one, two).alias("u"), F.least(one, two).alias("v"))
                       .filter(one.isNotNull() & two.isNotNull()).filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        # order-free checksum of the edge set: equal twice means nothing moved
        state = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.expr("pmod(xxhash64(v, u), 1000003)"))) \
            .first()
        if state == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen, last = state, now
        now = workers.keep(_small_star(_large_star(last)), "stars")
        workers.drop(last)
