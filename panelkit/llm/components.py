"""Connected components of a link table, as alternating star contractions.

Each step replaces links so that nodes point to the smallest node they see;
it needs only per-node minima (pre-aggregated) and joins back on the node, so a node with very many
links is an ordinary skewed join key, never one group in one task.  The number
of steps grows with the logarithm of the longest chain.  Each step is written to a scratch table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm import common as C


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a long, b long); root is the smallest node reachable."""
    now = C.saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        now = C.saved(small.select("x.*").where("a <> b").distinct(), "links")
        after = _state(now)
        if after == state:
            break
        state = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
