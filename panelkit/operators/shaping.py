"""Sorting, top-k, union and projection helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames, schema_of: DataFrame | None = None) -> DataFrame:
    """Concatenate same-schema frames by name, keeping duplicates.  An empty
    list gives an empty frame with the schema of ``schema_of``."""
    frames = list(frames)
    if not frames:
        if schema_of is None:
            raise ValueError("empty union needs a schema")
        return schema_of.where(F.lit(False))
    return reduce(lambda a, b: a.unionByName(b), frames)


def first_rows(df: DataFrame, keys, n: int) -> DataFrame:
    """First ``n`` rows under an explicit order (top-k: Spark plans this as
    TakeOrderedAndProject - a per-partition top-k, then a merge of n x P rows)."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(n)


def best_row(df: DataFrame, metric: str, ascending: bool = True) -> DataFrame:
    o = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    return df.orderBy(o).limit(1)
