"""Row-ordered window features per series (lag, rolling mean, back-fill)
that stay balanced when one series holds a large share of all rows.

``Window.partitionBy(series)`` puts a whole series into one task.  Here the
rows get a global ordinal over (series, order) from the range-partitioned
ordinal builder and are cut into fixed-size blocks of consecutive rows.  The
``H`` rows before every block, from however many blocks, are copied into it (a halo), so a
look-back of up to ``H`` rows is answered inside one block; neighbours that
belong to another series are masked.  Back-fill (an unbounded look-ahead) is a
two-level scan: inside each block, then a carry from later blocks computed on
a table with one row per (series, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordinal import with_ordinal

ORD = "__seq_ord"
BLK = "__seq_blk"
_HALO = "__seq_halo"
_SKEY = "__seq_key"

DEFAULT_BLOCK_ROWS = 1 << 20


def _as_list(x):
    return [x] if isinstance(x, (str, Column)) else list(x)


def sequenced(df: DataFrame, series, order, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Add a global ordinal over (series, order) and a block number."""
    series, order = _as_list(series), _as_list(order)
    out = with_ordinal(df, series + order, name=ORD)
    return out.withColumn(BLK, F.floor(F.col(ORD) / F.lit(block_rows)).cast("long"))


def _series_key(series) -> Column:
    return F.struct(*[F.col(s) for s in series]) if series else F.lit(0)


def add_lookback(sdf: DataFrame, series, lags: dict | None = None, rolls: dict | None = None,
                 block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """On a ``sequenced`` frame add

    * ``lags``:  {out: (col, k)}     value k rows earlier in the same series
    * ``rolls``: {out: (col, width)} mean of the current and width-1 earlier
      rows of the same series; partial windows allowed, NULLs skipped.
    """
    series = _as_list(series)
    lags, rolls = lags or {}, rolls or {}
    depth = max([k for _, k in lags.values()] + [w - 1 for _, w in rolls.values()] + [1])
    base = sdf.withColumn(_HALO, F.lit(False))
    # a row is copied into every later block that looks back at it
    reach = F.floor((F.col(ORD) + F.lit(depth)) / F.lit(block_rows)).cast("long")
    halo = (
        sdf.where(reach > F.col(BLK))
        .withColumn(BLK, F.explode(F.sequence(F.col(BLK) + 1, reach)))
        .withColumn(_HALO, F.lit(True))
    )
    u = base.unionByName(halo).withColumn(_SKEY, _series_key(series))
    w = Window.partitionBy(BLK).orderBy(ORD)
    cols = {}
    same = {j: F.lag(_SKEY, j).over(w).eqNullSafe(F.col(_SKEY)) for _, j in lags.values()}

    def back(c, j):
        if j == 0:
            return F.col(c)
        return F.when(same[j], F.lag(c, j).over(w))

    for out, (c, k) in lags.items():
        cols[out] = back(c, k)
    for out, (c, width) in rolls.items():  # one frame, however wide
        cols[out] = F.avg(F.col(c).cast("double")).over(Window.partitionBy(BLK, _SKEY).orderBy(ORD).rowsBetween(1 - width, 0))
    return u.withColumns(cols).where(~F.col(_HALO)).drop(_HALO, _SKEY)


def add_backfill(sdf: DataFrame, series, fills: dict) -> DataFrame:
    """On a ``sequenced`` frame set {out: col} = first non-NULL value of ``col``
    at or after the current row in the same series."""
    series = _as_list(series)
    names = list(fills)
    w_in = Window.partitionBy(BLK, *series).orderBy(ORD).rowsBetween(0, Window.unboundedFollowing)
    # one row per (series, block) holds the first non-NULL value of every column
    heads = sdf.groupBy(*series, BLK).agg(*[
        F.min_by(F.col(fills[n]), F.when(F.col(fills[n]).isNotNull(), F.col(ORD))).alias(f"__bf_{i}") for i, n in enumerate(names)])
    w_blk = Window.partitionBy(*series).orderBy(BLK).rowsBetween(1, Window.unboundedFollowing)
    carry = heads.select(*[F.col(s).alias(f"__bs_{i}") for i, s in enumerate(series)], F.col(BLK).alias("__bs_blk"), *[
        F.first(f"__bf_{i}", ignorenulls=True).over(w_blk).alias(f"__bf_{i}") for i in range(len(names))])
    inner = sdf.withColumns({f"__bi_{i}": F.first(F.col(fills[n]), ignorenulls=True).over(w_in) for i, n in enumerate(names)})
    same = F.col(BLK) == F.col("__bs_blk")
    for i, s in enumerate(series):  # a NULL series is a series too
        same = same & F.col(s).eqNullSafe(F.col(f"__bs_{i}"))
    out = inner.join(carry, same, "left").withColumns({n: F.coalesce(f"__bi_{i}", f"__bf_{i}") for i, n in enumerate(names)})
    return out.drop("__bs_blk", *[f"__bs_{i}" for i in range(len(series))], *[x for i in range(len(names)) for x in (f"__bi_{i}", f"__bf_{i}")])


def finish(sdf: DataFrame) -> DataFrame:
    return sdf.drop(ORD, BLK)
