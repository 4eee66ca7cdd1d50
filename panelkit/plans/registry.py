"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where one can be written, its SQL twin for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}

DIGITS = 6


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def round_half_up(c, digits: int = DIGITS):
    """floor(x * 10^d + 0.5) / 10^d - written with the same IEEE operations
    as the SQL twin, so both engines round an identical double identically
    (their built-in ``round`` functions break exact ties differently)."""
    x = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    special = F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(special, x).otherwise(F.floor(x * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every DOUBLE column: the float-compare policy shared with the
    SQL twins (engines may differ in the last bits of a sum or a corr)."""
    return df.select(*[
        round_half_up(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def rsql(sql: str, cols, digits: int = DIGITS) -> str:
    """Wrap an SQL twin so the named DOUBLE columns are rounded alike."""
    cols = list(cols)
    if not cols:
        return sql
    scale = f"{float(10 ** digits)!r}"
    rep = ", ".join(f"floor({c} * {scale} + 0.5) / {scale} AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS __r"
