"""Rows of vectors for the operators on embeddings: which rows take part, compact
storage, block grids, and bounded tree sums of per-partition states.

A row takes part if its vector is not null, holds no null or non-finite entry and has the table's
dimension (the length that most such rows have; the longer one on a tie).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm import common as C


def usable(df: DataFrame, vec_col: str, *columns) -> tuple[DataFrame, int]:
    """(rows that take part with ``columns`` and their vector ``v`` as doubles, dimension)."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(*columns, v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & fine)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    d = sizes.agg(F.max(F.struct("n", "d")).alias("top")).first().top
    dim = d.d if d else 0
    return rows.where(F.size("v") == dim), dim


def scaled(v="v"):
    """Each component c as the integer floor(256 * c)."""
    return F.transform(v, lambda c: F.floor(F.lit(256.0) * c).cast("long"))


def matrix(column: pa.Array, dim: int, kind=np.int64) -> np.ndarray:
    """A list column without nulls as a (rows x dim) array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dim)


def tree(states: DataFrame, schema: str, merge: Callable[[list[dict]], dict], slots: int, fan: int = 32) -> dict | None:
    """One state out of many (columns ``slot`` below ``slots``, and those of ``schema``), merged in groups of about
    ``fan`` on the executors, level by level.  Only the last one reaches the driver; None if there is none."""
    names = struct_of(schema).names

    def up(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        out = merge([{n: r[n] for n in names} for r in rows])
        return pa.Table.from_pylist([{"slot": rows[0]["slot"] // fan, **out}], schema=table.schema)

    while True:
        states = states.groupBy("slot").applyInArrow(up, f"slot int, {schema}")
        if slots == 1:
            break
        slots = -(-slots // fan)
    rows = states.select(*names).collect()  # one row
    return rows[0].asDict() if rows else None


def partials(rows: DataFrame, schema: str, fold: Callable, slots: int) -> DataFrame:
    """One state per partition: ``fold(batches)`` returns a dict, or None for a partition without rows."""
    out = C.arrow(struct_of(f"slot int, {schema}"))

    def run(batches):
        from pyspark import TaskContext

        state = fold(b for b in batches if b.num_rows)
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"slot": TaskContext.get().partitionId() % slots, **state}], schema=out)

    return rows.mapInArrow(run, f"slot int, {schema}")


def struct_of(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def blocks_for(n: int, block: int, least: int, at_least: int) -> int:
    """Number of blocks for n rows: at most ``block`` rows in each, and ``at_least`` blocks
    as long as each still has ``least`` rows."""
    return max(1, -(-n // block), min(at_least, n // least))


def grid(left: DataFrame, right: DataFrame, n_left: int, n_right: int, run: Callable, schema: str, left_at=None) -> DataFrame:
    """``run(left block, right block)`` for every pair of blocks.  Rows of both sides are dealt evenly by ``rid``;
    each block is sent once for every block of the other side, so a task holds one block of each.  ``left_at``: block of a
    left row, where the left side comes in blocks."""
    l_at = F.pmod(F.xxhash64("rid"), F.lit(n_left)).cast("int") if left_at is None else left_at
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # both sides may read one table: columns of its own
    r_at = F.pmod(F.xxhash64("rid"), F.lit(n_right)).cast("int")
    a = left.withColumns({"lb": l_at, "rb": F.explode(F.sequence(F.lit(0), F.lit(n_right - 1)))})
    b = right.withColumns({"rb": r_at, "lb": F.explode(F.sequence(F.lit(0), F.lit(n_left - 1)))})
    return a.groupBy("lb", "rb").cogroup(b.groupBy("lb", "rb")).applyInArrow(run, schema)


def best(rows: DataFrame, by: list, order: list, k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group, numbered from 1 (the limit is applied before the shuffle, too)."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn(name, rank).where(F.col(name) <= k)
