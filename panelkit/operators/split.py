"""Chronological split, train-only standard scaling and expanding-window
cross-validation folds, all built on the distributed ordinal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import attach_row
from .ordinal import row_count, with_ordinal


def split_chrono(df: DataFrame, order, ratio: float = 0.85, ordinal: str = "ordinal", name: str = "split") -> DataFrame:
    """First ``floor(n * ratio)`` rows under ``order`` are 'train', the rest
    'test'.  ``order`` should be a total order."""
    o = with_ordinal(df, order, name=ordinal)
    n = row_count(o)  # one row
    ntr = n.select(F.floor(F.col("n") * F.lit(float(ratio))).cast("long").alias("__ntr"))
    j = attach_row(o, ntr)
    return j.withColumn(name, F.when(F.col(ordinal) < F.col("__ntr"), "train").otherwise("test")).drop("__ntr")


def split_year(split_df: DataFrame, year: str = "year", name: str = "split") -> DataFrame:
    """Largest year among the training rows."""
    return split_df.where(F.col(name) == "train").agg(F.max(year).alias("split_year"))


def scale_fit(df: DataFrame, cols, where=None) -> DataFrame:
    """Long parameter table (column_name, mean, std) with population std on
    the selected rows; a zero std is replaced by 1."""
    cols = list(cols)
    d = df.where(where) if where is not None else df
    row = d.agg(*[x for i, c in enumerate(cols) for x in (
        F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"))])
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("mean"),
                             F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}")).alias("std"))
                    for i, c in enumerate(cols)])
    return row.select(F.explode(arr).alias("r")).select("r.column_name", "r.mean", "r.std")


def _param_row(params: DataFrame, cols) -> DataFrame:
    """Long (column_name, mean, std) -> one wide row, bounded by #columns."""
    return params.agg(*[x for c in cols for x in (
        F.max(F.when(F.col("column_name") == c, F.col("mean"))).alias(f"{c}__mean"),
        F.max(F.when(F.col("column_name") == c, F.col("std"))).alias(f"{c}__std"))])


def scale_apply(df: DataFrame, params: DataFrame, cols, suffix: str = "_scaled") -> DataFrame:
    """(x - mean) / std for every row, with the one-row parameter table
    attached as a scalar subquery."""
    cols = list(cols)
    j = attach_row(df, _param_row(params, cols))
    out = j.withColumns({f"{c}{suffix}": (F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__std") for c in cols})
    return out.drop(*[f"{c}__{s}" for c in cols for s in ("mean", "std")])


def expanding_folds(df: DataFrame, ordinal: str = "ordinal", n_splits: int = 5) -> DataFrame:
    """Expanding-window folds over rows with a dense 0-based ``ordinal``:
    test block length ``n // (n_splits + 1)``; fold i tests on block i of the
    tail and trains on every earlier row.  Emits (fold, role, row...)."""
    n = row_count(df)
    ts = n.select(F.col("n").alias("__n"), (F.col("n") / (n_splits + 1)).cast("long").alias("__ts"))
    j = attach_row(df, ts).withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    start = F.col("__n") - F.lit(n_splits) * F.col("__ts") + F.col("fold") * F.col("__ts")
    role = (F.when(F.col(ordinal) < start, "train")
            .when(F.col(ordinal) < start + F.col("__ts"), "test"))
    return j.withColumn("role", role).where(F.col("role").isNotNull()).drop("__n", "__ts")
