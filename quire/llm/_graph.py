"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import materialize, release, written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang every node's neighbours (the greater ones, or the smaller and itself)
    on the least node it can see.  Minima are combined before the shuffle and the
    join is one that Spark splits if a node has very many neighbours."""
    both = edges.select("a", "b")
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    met = both.join(least, "a")
    if large:
        out = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, name: str = "links", rows: int | None = None) -> DataFrame:
    """(node, root): root is the least node that links lead to.

    ``edges`` has long columns a and b.  Only nodes with a link are returned.
    Every round is written to the shared folder, and the one before deleted; rounds grow
    with the logarithm of the longest chain.  ``rows``: a bound of the number of edges, if known.
    """
    mark = written()
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name, rows)

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_003), F.lit(0))).first())

    at = state(now)
    while at[0]:
        large = materialize(_stars(now, True), f"{name}-large", 2 * at[0])
        now = materialize(_stars(large, False), f"{name}-small", 2 * at[0])
        release(mark, now)
        after = state(now)
        if after == at:
            break
        at = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
