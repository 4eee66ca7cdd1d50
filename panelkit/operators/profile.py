"""Profiling and statistics operators.

Every multi-column statistic is computed in one aggregate pass (partial
aggregation on the map side, a single tiny row at the end) instead of one
pass per column, and then reshaped to a long table with ``stack``-style
explode.  Quantile-based statistics use :mod:`.quantiles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import nan_as_null
from .joins import attach_group_stats, attach_row
from .quantiles import column_stats, quantile_row, quantiles

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def _long(row_df: DataFrame, items: list[tuple[str, dict]], name_col: str = "column_name") -> DataFrame:
    """Explode one wide row into one row per item; each item maps output
    field -> column of ``row_df``."""
    fields = list(items[0][1].keys())
    arr = F.array(*[
        F.struct(F.lit(n).alias(name_col), *[F.col(src).alias(f) for f, src in spec.items()]) for n, spec in items
    ])
    return row_df.select(F.explode(arr).alias("__r")).select(f"__r.{name_col}", *[f"__r.{f}" for f in fields])


def profile(df: DataFrame, labels=()) -> DataFrame:
    """Per column: type, rows, number of columns of the table, missing (NULL or NaN), numeric min/max, and for the
    columns named in ``labels`` the number of distinct labels - one pass."""
    num = set(numeric_columns(df))
    n_cols, labels = len(df.columns), set(labels)
    df = nan_as_null(df)
    aggs, items = [F.count(F.lit(1)).alias("__rows")], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"__m{i}"))
        if f.name in num:
            aggs += [F.min(c).cast("double").alias(f"__lo{i}"), F.max(c).cast("double").alias(f"__hi{i}")]
        else:
            aggs += [F.lit(None).cast("double").alias(f"__lo{i}"), F.lit(None).cast("double").alias(f"__hi{i}")]
        aggs.append((F.count_distinct(c) if f.name in labels else F.lit(None).cast("long")).alias(f"__d{i}"))
        items.append((f.name, {"data_type": f"__t{i}", "n_rows": "__rows", "n_columns": "__cols", "n_missing": f"__m{i}",
                               "min_value": f"__lo{i}", "max_value": f"__hi{i}", "n_labels": f"__d{i}"}))
    row = df.agg(*aggs)
    row = row.select("*", F.lit(n_cols).alias("__cols"), *[F.lit(f.dataType.simpleString()).alias(f"__t{i}") for i, f in enumerate(df.schema.fields)])
    return _long(row, items)


def describe(df: DataFrame, cols, method: str | None = None) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 %, max per column (exact quantiles)."""
    cols = list(cols)
    q = quantiles(df, cols, [0.25, 0.5, 0.75], method=method)
    basic = column_stats(df, cols, ["count", "mean", "std", "min", "max"]).withColumnRenamed("column", "column_name")
    qw = q.groupBy(F.col("column").alias("column_name")).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("p25"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("p50"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("p75"),
    )
    return basic.join(qw, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per label, missing dropped, most frequent first."""
    return (
        df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col(col))
    )


def missing_counts(df: DataFrame, cols=None) -> DataFrame:
    """Per column: rows that are NULL or NaN."""
    cols = list(cols or df.columns)
    df = nan_as_null(df, cols)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    return _long(row, [(c, {"n_missing": f"m{i}"}) for i, c in enumerate(cols)])


def duplicate_count(df: DataFrame, cols=None) -> DataFrame:
    """Rows that repeat an earlier row on ``cols`` (all columns by default);
    NULLs group together.  Partial aggregation keeps hot groups cheap."""
    cols = list(cols or df.columns)
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


def histogram(df: DataFrame, col, by=(), bins: int = 20) -> DataFrame:
    """Equal-width bins over each group's own [min, max], as numpy.histogram: a value belongs to the bin whose edges
    (lo + i * step; the last one is the maximum itself) enclose it, the last bin is
    right-closed; a constant group uses [v - 0.5, v + 0.5].  All bins are
    returned, empty ones with count 0.  With a list of columns all of them are
    counted in one pass, and ``column_name`` leads the result."""
    by = list(by)
    if isinstance(col, str):
        data = df.select(*by, F.col(col).cast("double").alias("__x"))
    else:
        one = F.array(*[F.struct(F.lit(c).alias("n"), F.col(c).cast("double").alias("x")) for c in col])
        data = df.select(*by, F.explode(one).alias("__s")).select(F.col("__s.n").alias("column_name"), *by, F.col("__s.x").alias("__x"))
        by = ["column_name", *by]
    data = data.where(F.col("__x").isNotNull() & ~F.isnan("__x"))
    rng = data.groupBy(*by).agg(F.min("__x").alias("__mn"), F.max("__x").alias("__mx"))
    rng = rng.select(
        *by,
        F.when(F.col("__mn") == F.col("__mx"), F.col("__mn") - 0.5).otherwise(F.col("__mn")).alias("lo"),
        F.when(F.col("__mn") == F.col("__mx"), F.col("__mx") + 0.5).otherwise(F.col("__mx")).alias("hi"),
    )
    j = attach_group_stats(data, rng, by)

    def edge(i):
        return F.when(i == bins, F.col("hi")).otherwise(F.col("lo") + i * ((F.col("hi") - F.col("lo")) / F.lit(float(bins))))

    guess = F.least(F.floor((F.col("__x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(float(bins))).cast("int"), F.lit(bins - 1))
    j = j.withColumn("__i", guess)
    i = F.col("__i")
    i = F.when(F.col("__x") < edge(i), i - 1).when((F.col("__x") >= edge(i + 1)) & (i < bins - 1), i + 1).otherwise(i)
    counts = j.groupBy(*by, i.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select(*by, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, [*by, "bin"], "left").select(
        *by, "bin", edge(F.col("bin")).alias("bin_lo"), edge(F.col("bin") + 1).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def iqr_outliers(df: DataFrame, cols, factor: float = 1.5, method: str | None = None) -> DataFrame:
    """Per column: Q1, Q3, fences and the count strictly outside them."""
    cols = list(cols)
    df = nan_as_null(df, cols)
    qs = quantile_row(df, cols, [0.25, 0.75], method=method, names=["q1", "q3"])
    j = attach_row(df.select(*cols), qs)  # one-row parameter table
    aggs, items = [], []
    for i, c in enumerate(cols):
        q1, q3 = F.col(f"{c}_q1"), F.col(f"{c}_q3")
        lo, hi = q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)
        aggs += [F.first(q1).alias(f"a{i}"), F.first(q3).alias(f"b{i}"), F.first(lo).alias(f"l{i}"),
                 F.first(hi).alias(f"h{i}"), F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"n{i}")]
        items.append((c, {"q1": f"a{i}", "q3": f"b{i}", "lower": f"l{i}", "upper": f"h{i}", "n_outliers": f"n{i}"}))
    return _long(j.agg(*aggs), items)


def box_stats(df: DataFrame, col: str, by=(), factor: float = 1.5, method: str | None = None) -> DataFrame:
    """Box-plot table per group: quartiles, whiskers (furthest points inside
    the fences, but not inside the box), outlier count."""
    by = list(by)
    df = nan_as_null(df, [col])
    q = quantile_row(df, [col], [0.25, 0.5, 0.75], by=by, method=method, names=["q1", "med", "q3"])
    q = q.select(*by, F.col(f"{col}_q1").alias("q1"), F.col(f"{col}_med").alias("median"), F.col(f"{col}_q3").alias("q3"))
    j = attach_group_stats(df.select(*by, F.col(col).cast("double").alias("__x")).where(F.col("__x").isNotNull()), q, by)
    lo = F.col("q1") - factor * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + factor * (F.col("q3") - F.col("q1"))
    return j.groupBy(*by).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.least(F.min(F.when(F.col("__x") >= lo, F.col("__x"))), F.first("q1")).alias("whisker_lo"),
        F.greatest(F.max(F.when(F.col("__x") <= hi, F.col("__x"))), F.first("q3")).alias("whisker_hi"),
        F.count_if((F.col("__x") < lo) | (F.col("__x") > hi)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"),
    )


def box_outlier_points(df: DataFrame, col: str, by=(), factor: float = 1.5, method: str | None = None) -> DataFrame:
    """The rows outside the fences of their group (the box plot's points)."""
    by = list(by)
    df = nan_as_null(df, [col])
    q = quantile_row(df, [col], [0.25, 0.75], by=by, method=method, names=["q1", "q3"])
    j = attach_group_stats(df, q, by)
    q1, q3 = F.col(f"{col}_q1"), F.col(f"{col}_q3")
    lo, hi = q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)
    return j.where((F.col(col) < lo) | (F.col(col) > hi)).drop(f"{col}_q1", f"{col}_q3")


def group_mean_std(df: DataFrame, col: str, by) -> DataFrame:
    df = nan_as_null(df, [col])
    return df.groupBy(*list(by)).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))


def corr_matrix(df: DataFrame, cols) -> DataFrame:
    """Pearson matrix (pairwise-complete; NaN is missing) in one aggregate; long (x, y, r)."""
    cols = list(cols)
    df = nan_as_null(df, cols)
    aggs, items = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}_{j}"))
    row = df.agg(*aggs)
    arr = F.array(*[
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{min(i, j)}_{max(i, j)}").alias("r"))
        for i, a in enumerate(cols) for j, b in enumerate(cols)
    ])
    return row.select(F.explode(arr).alias("__r")).select("__r.x", "__r.y", "__r.r")


def corr_rank(df: DataFrame, features, target: str) -> DataFrame:
    """Correlation of each feature with the target, strongest first, labelled
    strong (>0.5) / moderate (>0.3) / weak on |r|, positive if r > 0."""
    features = list(features)
    df = nan_as_null(df, [*features, target])
    row = df.agg(*[F.corr(F.col(f).cast("double"), F.col(target).cast("double")).alias(f"r{i}") for i, f in enumerate(features)])
    long = _long(row, [(f, {"r": f"r{i}"}) for i, f in enumerate(features)], name_col="feature")
    a = F.abs(F.col("r"))
    return long.select(
        "feature", "r",
        F.when(a > 0.5, "strong").when(a > 0.3, "moderate").otherwise("weak").alias("strength"),
        F.when(F.col("r") > 0, "positive").otherwise("negative").alias("direction"),
    ).orderBy(F.col("r").desc())


def scaled_check(df: DataFrame, cols, where=None, digits: int = 4) -> DataFrame:
    """Mean and sample std of (scaled) columns, rounded."""
    cols = list(cols)
    d = nan_as_null(df.where(where) if where is not None else df, cols)
    row = d.agg(*[x for i, c in enumerate(cols) for x in (
        F.round(F.avg(c), digits).alias(f"m{i}"), F.round(F.stddev_samp(c), digits).alias(f"s{i}"))])
    return _long(row, [(c, {"mean": f"m{i}", "std": f"s{i}"}) for i, c in enumerate(cols)])
