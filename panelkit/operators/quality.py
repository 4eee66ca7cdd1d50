"""Data-quality and cleaning operators: first-wins dedup, imputation,
IQR winsorization, source reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .joins import attach_row, inner_merge
from .quantiles import quantile_row


def dedup_keep_first(df: DataFrame, keys, order) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order`` (ascending, NULLs
    last), which names the columns that say which row came first (an ingest
    ordinal, a load time).  Rows that tie on ``order`` are told apart by their
    remaining columns, filled ones before NULL, so the survivor is fully
    determined.  Implemented as ``min`` of one struct per key -
    an aggregate with map-side partial aggregation, so a key holding a large
    share of the rows never lands whole in one task (unlike a
    ``row_number`` window)."""
    keys, order = list(keys), list(order)
    if not order:
        raise ValueError("name the columns that order the rows of a key")
    fields = order + [c for c in df.columns if c not in keys and c not in order]
    sort = [x for c in fields for x in (F.col(c).isNull(), F.col(c))]
    packed = F.struct(*[x.alias(f"f{i}") for i, x in enumerate(sort)])
    g = df.groupBy(*keys).agg(F.min(packed).alias("__first"))
    return g.select(*keys, *[F.col(f"__first.f{2 * i + 1}").alias(c) for i, c in enumerate(fields) if c not in keys]).select(*df.columns)


def impute(df: DataFrame, methods: dict, method: str | None = None, fit_where=None) -> DataFrame:
    """Fill missing values (NULL, NaN) with the column median or mean computed over all rows, or
    over the rows matching ``fit_where`` only (e.g. the training rows).
    ``methods`` maps column -> 'median' | 'mean'.  The statistics form
    one-row tables attached as scalar subqueries."""
    df = S.nan_as_null(df, list(methods))
    med = [c for c, m in methods.items() if m == "median"]
    mean = [c for c, m in methods.items() if m == "mean"]
    fit = df.where(fit_where) if fit_where is not None else df
    parts = []
    if mean:
        parts.append(fit.agg(*[F.avg(F.col(c).cast("double")).alias(f"{c}__fill") for c in mean]))
    if med:
        q = quantile_row(fit, med, [0.5], method=method, names=["fill"])
        parts.append(q.select(*[F.col(f"{c}_fill").alias(f"{c}__fill") for c in med]))
    j = df
    for p in parts:
        j = attach_row(j, p)
    out = j.withColumns({c: F.coalesce(F.col(c), F.col(f"{c}__fill").cast(df.schema[c].dataType)) for c in methods})
    return out.drop(*[f"{c}__fill" for c in methods])


def iqr_bounds(df: DataFrame, cols, factor: float = 1.5, method: str | None = None) -> DataFrame:
    """One row: ``{c}_lo``, ``{c}_hi`` = Q1 - f*IQR, Q3 + f*IQR per column."""
    cols = list(cols)
    q = quantile_row(df, cols, [0.25, 0.75], method=method, names=["q1", "q3"])
    sel = []
    for c in cols:
        q1, q3 = F.col(f"{c}_q1"), F.col(f"{c}_q3")
        sel += [(q1 - factor * (q3 - q1)).alias(f"{c}_lo"), (q3 + factor * (q3 - q1)).alias(f"{c}_hi")]
    return q.select(*sel)


def _clip(c, lo, hi):
    return F.when(F.col(c).isNull(), F.col(c)).otherwise(F.least(F.greatest(F.col(c), lo), hi))


def winsorize(df: DataFrame, cols, factor: float = 1.5, method: str | None = None, bounds: DataFrame | None = None,
              fit_where=None) -> DataFrame:
    """Cap each column to its IQR fences (missing values stay missing), computed over all rows or over the
    rows matching ``fit_where`` (unless ``bounds`` - a one-row table from
    :func:`iqr_bounds` - is given)."""
    cols = list(cols)
    df = S.nan_as_null(df, cols)
    fit = df.where(fit_where) if fit_where is not None else df
    b = bounds if bounds is not None else iqr_bounds(fit, cols, factor, method)
    j = attach_row(df, b)
    out = j.withColumns({c: _clip(c, F.col(f"{c}_lo"), F.col(f"{c}_hi")) for c in cols})
    return out.drop(*[f"{c}_{s}" for c in cols for s in ("lo", "hi")])


def winsor_counts(df: DataFrame, cols, factor: float = 1.5, method: str | None = None) -> DataFrame:
    """Rows strictly outside the fences (= rows capped) per column."""
    cols = list(cols)
    df = S.nan_as_null(df, cols)
    b = iqr_bounds(df, cols, factor, method)
    j = attach_row(df.select(*cols), b)
    row = j.agg(*[F.count_if((F.col(c) < F.col(f"{c}_lo")) | (F.col(c) > F.col(f"{c}_hi"))).alias(f"n{i}")
                  for i, c in enumerate(cols)])
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_capped")) for i, c in enumerate(cols)])
    return row.select(F.explode(arr).alias("r")).select("r.column_name", "r.n_capped")


def recon_rows(a: DataFrame, b: DataFrame, keys, a_val: str, b_val: str) -> DataFrame:
    """Inner join of two sources and the absolute % difference per key."""
    j = inner_merge(a.select(*keys, a_val), b.select(*keys, b_val), keys)
    return j.withColumn("diff_pct", S.abs_pct_diff(a_val, b_val))


def recon_summary(rows: DataFrame, threshold: float = 5.0) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("n_overlap"),
        F.avg("diff_pct").alias("mean_diff_pct"),
        F.count_if(F.col("diff_pct") > threshold).alias("n_exceptions"),
    )


def recon_exceptions(rows: DataFrame, keys, threshold: float = 5.0, n: int = 10) -> DataFrame:
    """First ``n`` keys (in key order) whose difference exceeds the threshold."""
    return rows.where(F.col("diff_pct") > threshold).orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(n)
