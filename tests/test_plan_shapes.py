"""Plan-shape and brute-force checks for the shared building blocks:
one-row parameter attachment, the fused statistics + quantile pass, and the
global ordinal."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.operators import joins as J
from panelkit.operators import ordinal as OR
from panelkit.operators import profile as P
from panelkit.operators import quantiles as Qm


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_attach_row_is_not_a_join(spark):
    big = spark.range(1000).withColumn("x", F.col("id").cast("double"))
    one = big.agg(F.avg("x").alias("m"), F.max("x").alias("hi"))
    out = J.attach_row(big, one)
    plan = _plan(out)
    assert "Join" not in plan and "Cartesian" not in plan
    rows = out.where("id IN (0, 999)").orderBy("id").collect()
    assert [(r.id, r.m, r.hi) for r in rows] == [(0, 499.5, 999.0), (999, 499.5, 999.0)]
    assert out.columns == ["id", "x", "m", "hi"]


def test_fused_stats_match_pandas_with_hot_value_and_missing(spark):
    rng = np.random.default_rng(7)
    a = np.where(rng.random(3000) < 0.34, 5.0, rng.normal(10, 3, 3000))  # a third of rows share one value
    b = rng.exponential(2.0, 3000)
    b[::50] = np.nan
    pdf = pd.DataFrame({"a": a, "b": b})
    df = spark.createDataFrame([(float(x), None if np.isnan(y) else float(y)) for x, y in zip(a, b)], "a double, b double")
    out = {r.column_name: r for r in P.describe(df, ["a", "b"]).collect()}
    for c in ("a", "b"):
        s = pdf[c].dropna()
        r = out[c]
        assert r["count"] == len(s)
        assert r["mean"] == pytest.approx(s.mean())
        assert r["std"] == pytest.approx(s.std(ddof=1))
        assert (r["min"], r["max"]) == (s.min(), s.max())
        for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            assert r[name] == pytest.approx(s.quantile(p))


def test_describe_keeps_all_missing_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    out = {r.column_name: r for r in P.describe(df, ["a", "b"]).collect()}
    assert out["b"]["count"] == 0 and out["b"]["mean"] is None and out["a"]["p50"] == pytest.approx(1.5)


def test_ordinal_dense_with_many_input_splits_and_ties(spark):
    # 32 input partitions against 8 shuffle partitions; heavy ties on the first key
    df = spark.range(0, 5000, 1, 32).withColumn("k", (F.col("id") % 3).cast("int"))
    out = OR.with_ordinal(df, ["k", "id"]).select("k", "id", "ordinal").toPandas()
    assert sorted(out["ordinal"]) == list(range(5000))
    expect = out.sort_values(["k", "id"])["ordinal"].tolist()
    assert expect == list(range(5000))


def test_impute_mixed_median_and_mean_matches_pandas(spark):
    from panelkit.operators import quality as QL

    rng = np.random.default_rng(3)
    a = rng.normal(50, 10, 800)
    b = rng.exponential(3.0, 800)
    a[::7] = np.nan
    b[::9] = np.nan
    pdf = pd.DataFrame({"a": a, "b": b})
    df = spark.createDataFrame([(None if np.isnan(x) else float(x), None if np.isnan(y) else float(y))
                                for x, y in zip(a, b)], "a double, b double")
    for method in ("histogram", "rank"):
        out = QL.impute(df, {"a": "median", "b": "mean"}, method=method).toPandas()
        exp = pdf.fillna({"a": pdf["a"].median(), "b": pdf["b"].mean()})
        assert np.allclose(np.sort(out["a"].to_numpy()), np.sort(exp["a"].to_numpy()))
        assert np.allclose(np.sort(out["b"].to_numpy()), np.sort(exp["b"].to_numpy()))


def test_ordinal_in_order_when_adaptive_execution_merges_range_partitions(spark):
    # many small range partitions merged into several larger ones by AQE
    keys = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = spark.range(0, 20000, 1, 16).withColumn("k", (F.col("id") * 7919 % 1000).cast("int"))
        out = OR.with_ordinal(df, ["k", "id"], keep_partition=True).select("k", "id", "ordinal", "__pk_pid").toPandas()
        assert out["__pk_pid"].nunique() > 1  # several (merged) partitions really were used
        assert sorted(out["ordinal"]) == list(range(20000))
        assert out.sort_values(["k", "id"])["ordinal"].tolist() == list(range(20000))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_group_stats_lookup_same_on_broadcast_and_shuffle_paths(spark):
    # group "hot" holds a third of the rows; the planner picks the join by size
    rows = [("hot" if i % 3 == 0 else f"g{i % 50}", float(i % 101)) for i in range(6000)]
    rows += [(None, 1.0), (None, 3.0)]  # NULL keys match each other (as pandas groupby + merge)
    df = spark.createDataFrame(rows, "g string, x double")
    st = df.groupBy("g").agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"))
    a = J.attach_group_stats(df, st, ["g"]).toPandas()
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
           if spark.conf.get(k, None) is not None}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        b = J.attach_group_stats(df, st, ["g"])
        assert "SortMergeJoin" in b._jdf.queryExecution().executedPlan().toString()
        b = b.toPandas()
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            if k in old:
                spark.conf.set(k, old[k])
            else:
                spark.conf.unset(k)
    key = ["g", "x", "m", "s"]
    a = a[key].sort_values(["g", "x"], na_position="first").reset_index(drop=True)
    b = b[key].sort_values(["g", "x"], na_position="first").reset_index(drop=True)
    assert len(a) == len(df.collect()) and a.equals(b)
    exp = pd.DataFrame(rows, columns=["g", "x"]).groupby("g", dropna=False)["x"].mean()
    got = a.groupby("g", dropna=False)["m"].first()
    assert np.allclose(got.sort_index().to_numpy(), exp.sort_index().to_numpy())
