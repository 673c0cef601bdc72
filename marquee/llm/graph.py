"""Connected components of large link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import materialize


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (the smallest node of its component) for every node
    of ``links`` (``a``, ``b``, longs).

    Alternates the large-star and small-star steps: each is one aggregation
    (partial sums first, so a hub costs no more than its links) and one join.
    Each round is written to a table, which cuts the lineage; only a count
    and a checksum come to the driver.  Repeated links, links both ways and
    links of a node with itself are allowed.
    """
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).dropna()
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    edges = materialize(_downward(links), "components")
    seen = _checksum(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written first, so that the join deals both sides anew and a hub's links can be split
        least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "components")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(_downward(large), "components")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "components")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select("a", F.col("m").alias("b")))
        edges = materialize(_downward(small), "components")
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return materialize(nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root")),
                       "components")


def _downward(edges: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller node."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
