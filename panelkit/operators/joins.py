"""Join operators.

``attach_group_stats`` is the one place where a statistics table is joined back onto its (large) source.  Its size depends on the number of
groups; the join's strategy is left to the planner and to adaptive execution, which know its bytes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_row(big: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table (fitted parameters, global
    statistics) to every row of ``big``.  The row is an uncorrelated scalar
    subquery: computed once, then used as a constant in the projection, so
    there is no join at all."""
    cols = one_row.columns
    p = one_row.select(F.struct(*[F.col(c) for c in cols]).alias("__p")).scalar()
    return big.withColumn("__p", p).withColumns({c: F.col("__p").getField(c) for c in cols}).drop("__p")


def attach_group_stats(big: DataFrame, stats: DataFrame, keys, how: str = "left") -> DataFrame:
    """Join per-group statistics onto every row of ``big``.  With no keys the
    statistics are a single row attached by :func:`attach_row`.  Nothing is counted or
    hinted: adaptive execution sees the statistics' bytes, broadcasts them where they are small and splits skewed groups elsewhere."""
    keys = list(keys)
    if not keys:
        return attach_row(big, stats)
    s = stats.select(*[F.col(k).alias(f"__g_{k}") for k in keys], *[c for c in stats.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys])
    return big.join(s, cond, how).drop(*[f"__g_{k}" for k in keys])


def outer_merge(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Full outer equi-merge on ``keys`` where NULL keys match each other
    (as pandas merge does); the key columns are coalesced from both sides.
    If one side is empty the result is the other side with the missing
    metric columns as typed NULLs."""
    keys = list(keys)
    a2 = a.select(*[F.col(k).alias(f"__a_{k}") for k in keys], *[c for c in a.columns if c not in keys])
    b2 = b.select(*[F.col(k).alias(f"__b_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    cond = reduce(lambda x, y: x & y, [F.col(f"__a_{k}").eqNullSafe(F.col(f"__b_{k}")) for k in keys])
    j = a2.join(b2, cond, "full")
    rest = [c for c in a.columns if c not in keys] + [c for c in b.columns if c not in keys]
    return j.select(*[F.coalesce(F.col(f"__a_{k}"), F.col(f"__b_{k}")).alias(k) for k in keys], *rest)


def inner_merge(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    return a.join(b, list(keys), "inner")
