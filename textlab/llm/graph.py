"""Connected components by joins, for links already known to be true."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.session import cut_lineage


def connected_components(links: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``links (a, b)`` long to ``(id, root)``: every id that has a link, and
    the smallest id of its component.

    Alternating large-star and small-star steps: each is one grouped minimum
    and one join on the present links, whose number never grows, until
    nothing changes (a logarithmic number of rounds).  Each round is
    checkpointed.  Only a row count and a checksum reach the driver.
    """
    def stars(e: DataFrame, large: bool) -> DataFrame:
        if large:
            n = e.select("a", "b").union(e.select(F.col("b"), F.col("a")))
        else:
            n = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        m = n.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        j = n.join(m, "a")
        if large:
            out = j.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                m.select("a", F.col("m").alias("b")))
        return out.where(F.col("a") != F.col("b")).distinct()

    state = None
    e = cut_lineage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where(F.col("a") != F.col("b")).distinct())
    for _ in range(max_rounds):
        e = cut_lineage(stars(stars(e, True), False))
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("id"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("id"), F.col("b").alias("root"))).distinct()
