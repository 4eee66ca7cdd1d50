"""Global row positions without a single-task window.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task.
Instead we:

1. range-partition + sort on the declared total order (the range partitioner
   samples the keys, so partitions are balanced; a salt column may be added
   as a last sort key so that a run of equal keys is split across tasks).
   Without ``num_partitions`` the sort uses ``spark.sql.shuffle.partitions``
   (the cluster's sizing of a shuffle) as an upper bound that adaptive
   execution may coalesce: merged range partitions are adjacent, so the
   order (partition id, position) is still the global order,
2. tag each row with its partition id and its position inside the partition
   (``monotonically_increasing_id`` keeps the record number in its low 33 bits),
3. write the result to the shared checkpoint folder (lineage cut, survives
   executor loss, and both passes below see the very same partitioning),
4. count rows per partition (one row per sorted partition),
   turn the counts into offsets with a running sum, and broadcast them back.

The only driver-side data is the per-partition count table, whose size is
bounded by the partition count (a configuration value), not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_PID = "__pk_pid"
_LOC = "__pk_loc"


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def sorted_tagged(df: DataFrame, order, num_partitions: int | None = None) -> DataFrame:
    """Globally sorted copy of ``df`` tagged with (partition id, local index),
    checkpointed to the shared folder."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    keys = _cols(order)
    r = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    s = r.sortWithinPartitions(*keys)
    pid = F.spark_partition_id()
    tagged = s.withColumn(_PID, pid).withColumn(
        _LOC, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    )
    return tagged.checkpoint(eager=True)


def with_ordinal(df: DataFrame, order, name: str = "ordinal", num_partitions: int | None = None,
                 keep_partition: bool = False) -> DataFrame:
    """Add a 0-based global position ``name`` following ``order`` (a list of
    column names / sort expressions).  Ties get distinct but arbitrary
    positions, so pass a total order when positions must be reproducible."""
    tagged = sorted_tagged(df, order, num_partitions)
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__pk_n"))
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partition count
    offsets = counts.select(_PID, F.coalesce(F.sum("__pk_n").over(w), F.lit(0)).alias("__pk_off"))
    out = tagged.join(F.broadcast(offsets), _PID).withColumn(name, F.col("__pk_off") + F.col(_LOC))
    drop = ["__pk_off", _LOC] + ([] if keep_partition else [_PID])
    return out.drop(*drop)


def row_count(df: DataFrame) -> DataFrame:
    """One-row DataFrame ``(n)`` - lazily computed, safe to broadcast."""
    return df.agg(F.count(F.lit(1)).alias("n"))
