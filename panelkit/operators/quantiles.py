"""Quantiles with linear interpolation (the pandas / numpy default).

Four methods:

* ``"histogram"`` (default) - exact, one lazy plan, no sort of the data.  Three
  aggregations refine the buckets that hold the wanted order statistics, along the digits of the doubles themselves:
  sign, exponent and the first 9 bits of the mantissa; then its next 21 bits; then the distinct values that share those, which
  differ in the last 22 bits.  So a pass has at most 2^22 keys for a column (or wanted bucket), whatever
  the magnitudes and however many rows.  Every aggregation combines on the
  map side and is keyed by the bucket too, so neither a hot value nor a column
  or group with a third of the rows meets in one task; running sums are taken over bucket tables only.
  A bucket whose values are all equal is not refined further.
* ``"rank"`` - exact and distributed by a global sort.  All requested columns are
  stacked into (group, column, value) rows, sorted once with a range
  partitioner (a random last key splits runs of equal values, so one hot value
  or group cannot pile into one task), given global ordinals, and the two
  neighbouring order statistics of every requested position are fetched with
  an equi-join on the ordinal.  Memory per task is bounded by the partition
  size, never by the number of distinct values.
* ``"exact"`` - Spark's ``percentile`` aggregate.  Exact, but its buffer is a
  map of distinct values that is merged in one task per group: use it only
  where the distinct count per group is known to be small.
* ``"approx"`` - ``percentile_approx`` (bounded memory, rank error
  1/accuracy); values are actual data points, not interpolated.

NULL and NaN are missing.  All return a long table ``(*by, column, p, value)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import no_nan
from .joins import attach_group_stats
from .ordinal import with_ordinal

DEFAULT_METHOD = "histogram"
DEFAULT_ACCURACY = 100_000
_TOP = 1 << 9       # slices of a power of two in the first aggregation
_FINE = 1 << 21     # slices of one of those in the second


def _stack(df: DataFrame, cols, by) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]))
    return df.select(*by, pairs.alias("__kv")).select(*by, "__kv.column", "__kv.value").where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def quantiles(df: DataFrame, cols, probs, by=(), method: str | None = None, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    method = method or DEFAULT_METHOD
    cols, probs, by = list(cols), [float(p) for p in probs], list(by)
    if method == "rank":
        return _rank_quantiles(df, cols, probs, by)
    if method == "histogram":
        return _histogram_quantiles(df, cols, probs, by)
    long = _stack(df, cols, by)
    if method == "exact":
        agg = F.percentile("value", F.array(*[F.lit(p) for p in probs]))
    elif method == "approx":
        agg = F.percentile_approx("value", F.array(*[F.lit(p) for p in probs]), accuracy)
    else:
        raise ValueError(f"unknown quantile method {method!r}")
    g = long.groupBy(*by, "column").agg(agg.alias("__q"))
    pa = F.array(*[F.lit(p) for p in probs])
    return g.select(*by, "column", F.explode(F.arrays_zip(pa.alias("p"), F.col("__q").alias("value"))).alias("z")).select(
        *by, "column", F.col("z.p").alias("p"), F.col("z.value").alias("value")
    )


# Per-column statistics over non-missing values, as pandas' describe.
STATS = {
    "count": lambda v: F.count(v),
    "mean": lambda v: F.avg(v),
    "std": lambda v: F.stddev_samp(v),
    "min": lambda v: F.min(v),
    "max": lambda v: F.max(v),
}


def column_stats(df: DataFrame, cols, stats) -> DataFrame:
    """(column, *stats): one wide aggregate, one row per column."""
    cols, stats = list(cols), list(stats)
    row = df.agg(*[STATS[s](no_nan(F.col(c).cast("double"))).alias(f"{i}_{s}") for i, c in enumerate(cols) for s in stats])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{i}_{s}").alias(s) for s in stats]) for i, c in enumerate(cols)
    ])).alias("r")).select("r.*")


def _digits(v):
    """(first, second) digit of a double, both in the order of the values: sign, exponent and 9 bits of the mantissa; the next 21 bits.
    Powers of two scale exactly, so no rounding moves a value over a border."""
    size = F.abs(v)
    near = F.floor(F.log2(size))
    power = F.when(size < F.pow(F.lit(2.0), near), near - 1).when(size >= F.pow(F.lit(2.0), near + 1), near + 1).otherwise(near)
    slices = (size / F.pow(F.lit(2.0), power) - 1) * _TOP
    first = F.when(size == 0, 0).when(size == float("inf"), 2100 * _TOP).otherwise((power + 1075) * _TOP + F.floor(slices))
    second = F.when((size == 0) | (size == float("inf")), 0).otherwise(F.floor((slices - F.floor(slices)) * _FINE))
    sign = F.signum(v)
    return (sign * first).cast("int"), (sign * second).cast("int")


#: What is known of a wanted order statistic: its rank ``r0`` among the group's values and ``rank`` inside the bucket (b, f), which spans lo..hi.
_FOUND = "struct<p:double,frac:double,r0:bigint,rank:bigint,b:int,f:int,lo:double,hi:double>"


def _histogram_quantiles(df: DataFrame, cols, probs, by) -> DataFrame:
    """Each pass attaches to the values one row per group, which lists its wanted order statistics, and narrows their buckets.  The list is
    a grouping key of the next pass's buckets (it depends on the group alone), so every pass reads the one before it once and the plan is a
    chain."""
    keys = [*by, "column"]
    # without groups there is one row per column
    small = (lambda d: d) if by else F.broadcast
    coarse, fine = _digits(F.col("value"))
    rows = _stack(df, cols, by).withColumn("__b", coarse)
    span = [F.count(F.lit(1)).alias("__c"), F.min("value").alias("__lo"), F.max("value").alias("__hi")]
    upto, before = F.col("__upto"), F.col("__upto") - F.col("__c")
    b, f = F.col("__b"), F.col("__f")

    def is_open(e):
        return e["lo"] < e["hi"]

    def narrowed(wanted, rank, f, lo, hi):
        """The entries of ``wanted`` whose ``rank`` lies in this bucket."""
        here = F.filter(wanted, lambda e: (e[rank] >= before) & (e[rank] < upto))
        return F.transform(here, lambda e: F.struct(e["p"], e["frac"], e["r0"], e[rank] - before, b, f, lo, hi).cast(_FOUND))

    def gathered(h, hits, *more):
        return h.withColumn("__hits", hits).groupBy(*keys, *more).agg(
            F.flatten(F.collect_list(F.when(F.size("__hits") > 0, F.col("__hits")))).alias("__hits"))

    def carried(h, hits):
        """One row per group: its entries that were narrowed in a bucket of ``h``, and those that were done before."""
        g = gathered(h, hits, "__want")
        return g.select(*keys, F.concat(F.filter("__want", lambda e: ~is_open(e)), "__hits").alias("__want"))

    h = rows.groupBy(*keys, "__b").agg(*span)
    h = h.withColumns({"__upto": F.sum("__c").over(Window.partitionBy(*keys).orderBy("__b")),
                       "__n": F.sum("__c").over(Window.partitionBy(*keys))})
    places = [(p, F.lit(p) * (F.col("__n") - 1)) for p in probs]
    asked = F.array(*[F.struct(F.lit(p).alias("p"), (pos - F.floor(pos)).alias("frac"), side(pos).cast("long").alias("r0"))
                      for p, pos in places for side in (F.floor, F.ceil)])
    want = gathered(h, narrowed(asked, "r0", F.lit(None), F.col("__lo"), F.col("__hi"))).withColumnRenamed("__hits", "__want")

    # the next digits inside each wanted bucket; the rows of a bucket that is done stay together, so no group is lost
    near = attach_group_stats(rows, small(want), keys, "inner").where(F.exists("__want", lambda e: e["b"] == b))
    near = near.withColumn("__f", F.when(F.exists("__want", lambda e: (e["b"] == b) & is_open(e)), fine))
    h = near.groupBy(*keys, "__want", "__b", "__f").agg(*span)
    h = h.withColumn("__upto", F.sum("__c").over(Window.partitionBy(*keys, "__b").orderBy("__f")))
    mine = F.filter("__want", lambda e: (e["b"] == b) & is_open(e))
    want = carried(h, narrowed(mine, "rank", f, F.col("__lo"), F.col("__hi")))

    # the distinct values of what is still open
    near = attach_group_stats(rows.withColumn("__f", fine), small(want), keys, "inner")
    near = near.where(F.exists("__want", lambda e: (e["b"] == b) & (~is_open(e) | (e["f"] == f))))
    mine = F.filter("__want", lambda e: (e["b"] == b) & (e["f"] == f) & is_open(e))
    near = near.withColumn("__v", F.when(F.size(mine) > 0, F.col("value"))).withColumn("__f", F.when(F.col("__v").isNotNull(), f))
    h = near.groupBy(*keys, "__want", "__b", "__f", "__v").agg(F.count(F.lit(1)).alias("__c"))
    h = h.withColumn("__upto", F.sum("__c").over(Window.partitionBy(*keys, "__b", "__f").orderBy("__v")))
    want = carried(h, narrowed(mine, "rank", f, F.col("__v"), F.col("__v")))

    both = want.select(*keys, F.explode("__want").alias("e")).groupBy(*keys, F.col("e.p").alias("p")).agg(
        F.first("e.frac").alias("__frac"), F.min_by("e.lo", "e.r0").alias("__vlo"), F.max_by("e.lo", "e.r0").alias("__vhi"))
    val = F.when(F.col("__frac") == 0, F.col("__vlo")).otherwise(
        F.col("__vlo") + (F.col("__vhi") - F.col("__vlo")) * F.col("__frac"))
    return both.select(*keys, "p", val.alias("value"))


def _rank_quantiles(df: DataFrame, cols, probs, by) -> DataFrame:
    long = _stack(df, cols, by)
    keys = [*by, "column", "value", F.rand(17)]
    ranked = with_ordinal(long, keys, name="__o")
    groups = ranked.groupBy(*by, "column").agg(F.min("__o").alias("__start"), F.count(F.lit(1)).alias("__n"))
    pa = F.array(*[F.lit(p) for p in probs])
    tgt = groups.select(*by, "column", "__start", "__n", F.explode(pa).alias("p")).withColumn(
        "__pos", F.col("p") * (F.col("__n") - 1)
    ).withColumn("__lo", F.floor("__pos").cast("long")).withColumn("__hi", F.ceil("__pos").cast("long")).withColumn(
        "__frac", F.col("__pos") - F.col("__lo")
    )
    need = tgt.select(
        *by, "column", "p", "__frac",
        F.explode(F.array(
            F.struct(F.lit(0).alias("side"), (F.col("__start") + F.col("__lo")).alias("__o")),
            F.struct(F.lit(1).alias("side"), (F.col("__start") + F.col("__hi")).alias("__o")),
        )).alias("s"),
    ).select(*by, "column", "p", "__frac", "s.side", "s.__o")
    picks = ranked.select("__o", F.col("value").alias("__v"))
    # without groups the targets are 2 x columns x probs rows
    joined = picks.join(need if by else F.broadcast(need), "__o")
    g = joined.groupBy(*by, "column", "p").agg(
        F.max(F.when(F.col("side") == 0, F.col("__v"))).alias("__vlo"),
        F.max(F.when(F.col("side") == 1, F.col("__v"))).alias("__vhi"),
        F.first("__frac").alias("__frac"),
    )
    val = F.when(F.col("__frac") == 0, F.col("__vlo")).otherwise(
        F.col("__vlo") + (F.col("__vhi") - F.col("__vlo")) * F.col("__frac")
    )
    return g.select(*by, "column", "p", val.alias("value"))


def quantile_row(df: DataFrame, cols, probs, by=(), method: str | None = None, names=None) -> DataFrame:
    """Wide form: one row per group with ``{col}_{name}`` columns, where
    ``names`` labels the probabilities (default ``p25`` style)."""
    by = list(by)
    names = names or [f"p{int(round(p * 100))}" for p in probs]
    long = quantiles(df, cols, probs, by, method)
    label = F.element_at(F.create_map(*[x for p, n in zip(probs, names) for x in (F.lit(float(p)), F.lit(n))]), F.col("p"))
    long = long.withColumn("__name", F.concat(F.col("column"), F.lit("_"), label))
    wanted = [f"{c}_{n}" for c in cols for n in names]
    if by:
        return long.groupBy(*by).pivot("__name", wanted).agg(F.first("value"))
    return long.groupBy().pivot("__name", wanted).agg(F.first("value"))
