"""Literal unit tests for the semantic traps."""

import math

import pytest
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import quality as QL
from panelkit.operators import quantiles as Qm


def test_winsorize_literals(spark):
    # sorted: -90 2 4 6 8 300; quartiles at positions 1.25 and 3.75: 2.5 and 7.5; fences -5 and 15
    vals = [4.0, -90.0, 8.0, 2.0, 300.0, 6.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for method in ("histogram", "rank", "exact"):
        out = QL.winsorize(df, ["x"], method=method).collect()
        assert sorted(r.x for r in out) == pytest.approx([-5.0, 2.0, 4.0, 6.0, 8.0, 15.0])
        n = QL.winsor_counts(df, ["x"], method=method).first().n_capped
        assert n == 2


def test_quantile_methods_agree_with_hot_values(spark):
    # one value holds a third of the rows; groups of very different sizes
    rows = [(g, float(i % 17) if i % 3 else 5.0) for g in ("a", "b") for i in range(300 if g == "a" else 31)]
    rows += [("c", 42.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    res = {}
    for m in ("histogram", "rank", "exact"):
        q = Qm.quantiles(df, ["x"], probs, by=["g"], method=m).collect()
        res[m] = {(r.g, r.p): r.value for r in q}
    for k, v in res["exact"].items():
        assert res["histogram"][k] == pytest.approx(v)
        assert res["rank"][k] == pytest.approx(v)


def test_quantile_linear_interpolation(spark):
    df = spark.createDataFrame([(v,) for v in [4.0, -90.0, 8.0, 2.0, 300.0, 6.0]], "x double")
    q = {r.p: r.value for r in Qm.quantiles(df, ["x"], [0.25, 0.75]).collect()}
    assert q[0.25] == pytest.approx(2.5) and q[0.75] == pytest.approx(7.5)


def test_dedup_keep_first_hot_key(spark):
    rows = [(1, i, f"v{i:03d}") for i in range(200)] + [(2, 5, "z"), (2, 3, "y")]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    out = {r.k: (r.o, r.v) for r in QL.dedup_keep_first(df, ["k"], order=["o"]).collect()}
    assert out == {1: (0, "v000"), 2: (3, "y")}


def test_ratio_clip_and_division_traps(spark):
    df = spark.createDataFrame([(0.0, 5.0), (0.0, 0.0), (10.0, 4.0), (10.0, 9.0), (None, 1.0), (0.0, -1.0)], "d double, n double")
    out = df.select(S.ratio_clip("n", "d").alias("r"), S.abs_pct_diff("n", "d").alias("p")).collect()
    assert [r.r for r in out] == [1.0, None, 0.5, 0.9, None, 0.5]
    assert out[0].p is None and out[1].p is None


def test_parse_period_label(spark):
    labels = ["1978/1979", "1979", "1979.0", " 1980 ", "FY 1981", "1979.7", "1978.0/1979", None, "nan"]
    df = spark.createDataFrame([(s,) for s in labels], "s string")
    out = [r.y for r in df.select(S.parse_period_label("s").alias("y")).collect()]
    assert out == [1978, 1979, 1979, 1980, None, 1979, None, None, None]


def test_strip_title_encode(spark):
    df = spark.createDataFrame([("\tmaha ",), ("YALA",), (None,)], "s string")
    out = df.select(S.norm_label("s").alias("t"), S.encode_binary("s", "Maha").alias("b")).collect()
    assert [(r.t, r.b) for r in out] == [("Maha", 1), ("Yala", 0), (None, 0)]


def test_numeric_coerce(spark):
    df = spark.createDataFrame([(" 12 ",), ("1,234",), ("n/a",), ("NaN",), ("-3.5",)], "s string")
    out = [r.x for r in df.select(S.to_double("s").alias("x")).collect()]
    assert out == [12.0, None, None, None, -3.5]


def test_fit_where_uses_training_rows_only(spark):
    # train rows: 1, 2, 3, NULL; test rows: 100, 200 (would move the median and the fences)
    rows = [(1.0, "train"), (2.0, "train"), (3.0, "train"), (None, "train"), (100.0, "test"), (200.0, "test")]
    df = spark.createDataFrame(rows, "x double, split string")
    tr = F.col("split") == "train"
    filled = QL.impute(df, {"x": "median"}, fit_where=tr).where(F.col("split") == "train").collect()
    assert sorted(r.x for r in filled) == [1.0, 2.0, 2.0, 3.0]
    all_rows = QL.impute(df, {"x": "median"}).where(F.col("split") == "train").collect()
    assert sorted(r.x for r in all_rows) == [1.0, 2.0, 3.0, 3.0]  # median of 1, 2, 3, 100, 200
    # fences from the train rows: q1 1.5, q3 2.5 -> [0, 4]; test values are capped to 4
    w = QL.winsorize(df, ["x"], fit_where=tr).where(F.col("split") == "test").collect()
    assert sorted(r.x for r in w) == [4.0, 4.0]


def test_clean_fit_on_train_keeps_layout(spark):
    from conftest import SF_SMALL
    from panelkit.plans import bindings as B
    from panelkit.plans import flows as FL

    p = B.panel(spark, SF_SMALL)
    a = FL.clean(p)
    t = FL.clean(p, fit_on="train")
    assert a.columns == t.columns
    assert a.count() == t.count()
    ka = {(r.series, r.year, r.month): r.split for r in a.select("series", "year", "month", "split").collect()}
    kt = {(r.series, r.year, r.month): r.split for r in t.select("series", "year", "month", "split").collect()}
    assert ka == kt
    with pytest.raises(ValueError):
        FL.clean(p, fit_on="test")
