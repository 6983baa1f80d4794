"""Connected components by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverair.session import materialise


def smallest_reachable(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, its smallest reachable node, for every node of ``links`` (a, b).

    Alternating star rounds (Kiveris et al., 2014): each node hands its larger
    neighbours to the smallest one, then its smaller ones. Minima combine on the
    map side, and the joins have one row per node on one side, so AQE can split a
    node with very many links. Each round is written to the shared folder, which
    cuts the lineage. Rounds end when the links no longer change.
    """
    stars = _down(links)
    before = None
    while True:
        stars = materialise(_small(_large(stars)), "stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if now == before:
            return stars.select(F.col("high").alias("node"), F.col("low").alias("root")).union(
                stars.select("low", "low").distinct()
            )
        before = now


def _down(links: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller node."""
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    return pairs.distinct()


def _large(stars: DataFrame) -> DataFrame:
    both = stars.select(F.col("high").alias("at"), F.col("low").alias("other")).union(stars.select("low", "high"))
    least = both.groupBy("at").agg(F.min("other").alias("least"))
    least = least.select("at", F.least("at", "least").alias("least"))
    moved = both.where("other > at").join(least, "at")
    return moved.select(F.col("other").alias("high"), F.col("least").alias("low")).distinct()


def _small(stars: DataFrame) -> DataFrame:
    least = stars.groupBy("high").agg(F.min("low").alias("least"))
    moved = stars.join(least, "high").where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return moved.union(least.select("high", F.col("least").alias("low"))).distinct()
