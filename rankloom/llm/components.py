"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.staging import stage

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """Per `node` of the links (`a`, `b`) its component's smallest node, `root`.

    Alternates two steps until nothing changes: each node links its larger
    neighbours to its smallest one, then its smaller ones and itself. Rounds grow
    with the logarithm of the number of nodes. Each is written to the shared
    folder, so none is computed again. A node with many neighbours is reduced in
    the map tasks, and split as a skewed key where the minimum is joined back.
    """
    links = stage(_pointing_down(edges), "components")
    state = _state(links)
    for _ in range(ROUNDS):
        links = stage(_small_star(_large_star(links)), "components")
        before, state = state, _state(links)
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
    raise RuntimeError(f"components not found in {ROUNDS} rounds")


def _pointing_down(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger node `a` to the smaller `b`."""
    pair = edges.where(F.col("a") != F.col("b"))
    return pair.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("digest")
    ).first()
    return row.n, row.digest


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    larger = both.where(F.col("b") > F.col("a")).join(least, "a")
    return _pointing_down(larger.select(F.col("b").alias("a"), F.col("least").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    joined = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _pointing_down(joined.unionByName(least.select("a", F.col("least").alias("b"))))
