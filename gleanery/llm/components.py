"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links between ids of any type with an order -> one row (node, root) per node that has a link, root the least id of its component.

    Every step is a min per key, pre-aggregated before its shuffle, and an equi-join whose large
    keys Spark can split, so a node with very many links is no hot spot. The links of each round
    are written to the shared folder; rounds end when the links stay as they are, after about the square of the logarithm of their
    number. Self-links and repeated links do no harm; no links give no rows.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = materialize(e, "links")
    state = _state(e)
    before = None
    while state[0] and state != before:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = materialize(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, state = state, _state(e)
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
