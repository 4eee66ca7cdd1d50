"""Panel feature operators: lags, rolling means, back-fill, interactions,
seasonal anomaly flag, clipped efficiency ratio."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import sequence as Q
from .joins import attach_group_stats


def lags_and_rolls(df: DataFrame, series, order, lags: dict | None = None, rolls: dict | None = None,
                   backfill: dict | None = None, block_rows: int = Q.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """One sequencing pass shared by every look-back feature.  ``series`` may
    be empty (one national series)."""
    series = list(series)
    sdf = Q.sequenced(df, series, order, block_rows)
    out = Q.add_lookback(sdf, series, lags, rolls, block_rows)
    if backfill:
        out = Q.add_backfill(out, series, backfill)
    return Q.finish(out)


def anomaly_flag(df: DataFrame, col: str, by, k: float = 1.0, name: str = "drought_flag", fit_where=None) -> DataFrame:
    """1 if ``col`` < group mean - k * group sample std, else 0 (missing -> 0).
    The group statistics use all rows, or the rows matching ``fit_where``."""
    by = list(by)
    df = S.nan_as_null(df, [col])
    fit = df.where(fit_where) if fit_where is not None else df
    stats = fit.groupBy(*by).agg(F.avg(col).alias("__mean"), F.stddev_samp(col).alias("__std"))
    j = attach_group_stats(df, stats, by)
    cond = F.col(col) < F.col("__mean") - F.lit(k) * F.col("__std")
    return j.withColumn(name, F.coalesce(cond, F.lit(False)).cast("int")).drop("__mean", "__std")


def add_interactions(df: DataFrame, pairs: dict) -> DataFrame:
    """{out: (a, b)} -> a * b."""
    return df.withColumns({o: S.interaction(a, b) for o, (a, b) in pairs.items()})


def add_efficiency(df: DataFrame, num: str, den: str, name: str = "harvest_efficiency",
                   lo: float = 0.5, hi: float = 1.0) -> DataFrame:
    return df.withColumn(name, S.ratio_clip(num, den, lo, hi))
