"""Rules whose expected values were worked out by hand: missing values, R^2,
first-wins deduplication, routing, histogram edges, whiskers, look-back across blocks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import features as FE
from panelkit.operators import ml as M
from panelkit.operators import profile as P
from panelkit.operators import quality as QL
from panelkit.operators import quantiles as Qm
from panelkit.operators import sequence as SQ
from panelkit.sources import readers as R

NAN = float("nan")


@pytest.fixture(scope="module")
def holey(spark):
    # 1..5 with a NaN and a NULL; y is twice x, with its own NaN
    rows = [(1.0, 2.0), (2.0, 4.0), (3.0, NAN), (4.0, 8.0), (5.0, 10.0), (NAN, 7.0), (None, 7.0)]
    return spark.createDataFrame(rows, "x double, y double")


def test_nan_is_missing(spark, holey):
    assert {r.column_name: r.n_missing for r in P.missing_counts(holey).collect()} == {"x": 2, "y": 1}
    p = {r.column_name: r for r in P.profile(holey).collect()}
    assert (p["x"].n_missing, p["x"].max_value, p["x"].n_columns, p["y"].n_missing) == (2, 5.0, 2, 1)
    d = P.describe(holey, ["x"]).first()
    assert (d["count"], d["mean"], d["min"], d["p25"], d["p50"], d["p75"], d["max"]) == (5, 3.0, 1.0, 2.0, 3.0, 4.0, 5.0)
    assert sorted(r.x for r in QL.impute(holey, {"x": "median"}).collect()) == [1.0, 2.0, 3.0, 3.0, 3.0, 4.0, 5.0]
    assert sorted(r.x for r in QL.impute(holey, {"x": "mean"}).collect()) == [1.0, 2.0, 3.0, 3.0, 3.0, 4.0, 5.0]
    capped = [r.x for r in QL.winsorize(holey, ["x"]).collect()]  # fences -1 and 7: nothing is capped, missing stays missing
    assert sorted(x for x in capped if x is not None) == [1.0, 2.0, 3.0, 4.0, 5.0] and capped.count(None) == 2
    assert QL.winsor_counts(holey, ["x"]).first().n_capped == 0
    assert P.iqr_outliers(holey, ["x"]).first().n_outliers == 0
    assert P.box_stats(holey, "x").first().n == 5
    r = {(x.x, x.y): x.r for x in P.corr_matrix(holey, ["x", "y"]).collect()}  # pairs (1,2) (2,4) (4,8) (5,10)
    assert r[("x", "y")] == pytest.approx(1.0)
    assert P.corr_rank(holey, ["x"], "y").first().r == pytest.approx(1.0)


def test_nan_in_a_group_does_not_flag_the_others(spark):
    rows = [("a", v) for v in (10.0, 10.0, 10.0, 1.0, NAN)]  # mean 7.75, std 4.5: below 3.25 is an anomaly
    out = FE.anomaly_flag(spark.createDataFrame(rows, "g string, x double"), "x", ["g"]).collect()
    assert sorted((r.drought_flag, r.x is None) for r in out) == [(0, False), (0, False), (0, False), (0, True), (1, False)]


def test_r2_of_large_targets(spark):
    # y = 1e9 + (0, 1, 2, 3), off by 0.5: SSE 4 * 0.25 = 1, SST 5
    rows = [("m", "test", 1e9 + i, 1e9 + i + 0.5) for i in range(4)]
    rows += [("flat", "test", 7.0, 7.0), ("flat", "test", 7.0, 7.0), ("off", "test", 7.0, 8.0), ("off", "test", 7.0, 7.0)]
    got = {r.model: r.r2 for r in M.metrics(spark.createDataFrame(rows, "model string, split string, y double, pred double")).collect()}
    assert got["m"] == pytest.approx(0.8) and got["flat"] == 1.0 and got["off"] == 0.0


def test_first_row_wins(spark):
    rows = [(1, "a", 10.0, 2), (1, "a", None, 1), (2, "b", None, 5), (2, "b", 3.0, 5), (3, "c", 1.0, None), (3, "c", 9.0, 4)]
    df = spark.createDataFrame(rows, "k int, s string, v double, seq int")
    out = {r.k: (r.v, r.seq) for r in QL.dedup_keep_first(df, ["k", "s"], order=["seq"]).collect()}
    # earliest seq, even if its value is missing; on a tie the filled row; a row without seq comes last
    assert out == {1: (None, 1), 2: (3.0, 5), 3: (9.0, 4)}
    with pytest.raises(ValueError):
        QL.dedup_keep_first(df, ["k"], order=[])


def test_routing_looks_at_the_stem_only(spark):
    paths = ["/data/maha/sown_extent_yala.xlsx", "/x/yield/notes.v2.xlsx", "production_MAHA", "/a.b/Yeild_maha.tar.gz", ".yala"]
    df = spark.createDataFrame([(p,) for p in paths], "path string").withColumns(R.route_path("path"))
    got = [(r.metric_route, r.extent_route, r.season) for r in df.collect()]
    assert got == [(None, "sown", "Yala"), (None, None, "Unknown"), ("production", None, "Maha"), ("yield", None, "Maha"), (None, None, "Yala")]


def test_histogram_matches_numpy_on_decimal_edges(spark):
    rng = np.random.default_rng(8)
    samples = {f"g{i}": np.round(rng.uniform(0, 10, 60), 2) for i in range(40)}
    samples["flat"], samples["edge"] = np.array([0.3, 0.3]), np.round(np.arange(0, 1.01, 0.1), 1)
    df = spark.createDataFrame([(g, float(x)) for g, xs in samples.items() for x in xs], "g string, x double")
    got = {(r.g, r.bin): (r.n, r.bin_lo, r.bin_hi) for r in P.histogram(df, "x", ["g"], bins=20).collect()}
    for g, xs in samples.items():
        n, edges = np.histogram(xs, bins=20)
        assert [got[g, i][0] for i in range(20)] == n.tolist(), g
        assert got[g, 0][1] == edges[0] and got[g, 19][2] == edges[20]


def test_histogram_of_several_columns(spark):
    df = spark.createDataFrame([(0.0, 5.0), (1.0, 6.0), (2.0, NAN), (3.0, 9.0)], "a double, b double")
    got = {(r.column_name, r.bin): r.n for r in P.histogram(df, ["a", "b"], bins=2).collect()}
    assert got == {("a", 0): 2, ("a", 1): 2, ("b", 0): 2, ("b", 1): 1}


def test_whiskers_stay_outside_the_box(spark):
    # -100 10 10 10: q1 = -17.5, q3 = 10, fences -58.75 and 51.25; the least point inside them (10) is above q1
    b = P.box_stats(spark.createDataFrame([(v,) for v in (-100.0, 10.0, 10.0, 10.0)], "x double"), "x").first()
    assert (b.q1, b.q3, b.whisker_lo, b.whisker_hi, b.n_outliers) == (-17.5, 10.0, -17.5, 10.0, 1)


@pytest.mark.parametrize("block", [1, 2, 3, 100])
def test_look_back_over_several_blocks(spark, block):
    df = spark.createDataFrame([(i, float(i)) for i in range(9)], "t int, v double")
    out = FE.lags_and_rolls(df, [], ["t"], lags={"lag5": ("v", 5)}, rolls={"mean4": ("v", 4)}, block_rows=block).orderBy("t").collect()
    assert [r.lag5 for r in out] == [None] * 5 + [0.0, 1.0, 2.0, 3.0]
    assert [r.mean4 for r in out] == [0.0, 0.5, 1.0, 1.5, 2.5, 3.5, 4.5, 5.5, 6.5]
    assert SQ.DEFAULT_BLOCK_ROWS > 0


def test_histogram_quantiles_on_hard_values(spark):
    rng = np.random.default_rng(5)
    cols = {
        "wide": np.concatenate([10.0 ** rng.uniform(-300, 300, 500), -(10.0 ** rng.uniform(-5, 5, 500))]),
        "narrow": 1e9 + np.arange(1000) * 1e-6, "hot": np.where(rng.random(1000) < 0.7, 3.25, rng.normal(size=1000)),
        "tiny": rng.normal(size=1000) * 1e-310, "whole": rng.integers(-5, 5, 1000).astype(float),
    }
    df = spark.createDataFrame(list(zip(*[map(float, v) for v in cols.values()], strict=True)), [*cols])
    probs = [0.0, 0.1, 0.25, 0.333, 0.5, 0.75, 0.999, 1.0]
    got = {(r.column, r.p): r.value for r in Qm.quantiles(df, list(cols), probs).collect()}
    for c, v in cols.items():
        for p in probs:
            assert math.isclose(got[c, p], float(np.quantile(v, p)), rel_tol=1e-9, abs_tol=1e-320), (c, p)
    by = {(r.whole, r.p): r.value for r in Qm.quantiles(df, ["hot"], [0.5], by=["whole"]).collect()}
    for w in range(-5, 5):
        assert by[float(w), 0.5] == pytest.approx(float(np.median(cols["hot"][cols["whole"] == w])))


def test_quantile_plan_has_no_exchange_by_column_alone(spark):
    df = spark.createDataFrame([(float(i), float(-i)) for i in range(50)], "a double, b double")
    plan = Qm.quantiles(df, ["a", "b"], [0.25, 0.75])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    Qm.quantiles(df, ["a", "b"], [0.25, 0.75])
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before  # building it runs nothing
