"""A small panel with hand-computed lags, rolling means, flags, split, scaling and OLS coefficients."""

import pytest
from pyspark.sql import functions as F

from panelkit.operators import features as FE
from panelkit.operators import ml as M
from panelkit.operators import split as SP
from panelkit.plans.reference_panel import SPEC

# season, rainfall, target by year and season order (Maha first)
ROWS = [
    (2001, "Maha", 100.0, 10.0), (2001, "Yala", 40.0, 4.0), (2002, "Maha", 120.0, 12.0), (2002, "Yala", 50.0, 6.0),
    (2003, "Maha", 20.0, 8.0), (2003, "Yala", 45.0, 5.0), (2004, "Maha", 110.0, 14.0), (2004, "Yala", 42.0, 7.0),
]


@pytest.fixture(scope="module")
def panel(spark):
    rows = [(y, s, 0 if s == "Maha" else 1, r, t) for y, s, r, t in ROWS]
    return spark.createDataFrame(rows, "year int, season string, season_code int, rain double, target double").repartition(4)


def test_lags_rolls_and_backfill(panel):
    out = FE.lags_and_rolls(panel, [], ["year", "season_code"], lags={"l1": ("target", 1), "l2": ("target", 2)},
                            rolls={"roll3": ("rain", 3)}, backfill={"f2": "l2"}).orderBy("year", "season_code").collect()
    assert [r.l1 for r in out] == [None, 10.0, 4.0, 12.0, 6.0, 8.0, 5.0, 14.0]
    assert [r.l2 for r in out] == [None, None, 10.0, 4.0, 12.0, 6.0, 8.0, 5.0]
    assert [r.f2 for r in out] == [10.0, 10.0, 10.0, 4.0, 12.0, 6.0, 8.0, 5.0]
    assert [round(r.roll3, 4) for r in out] == [100.0, 70.0, 86.6667, 70.0, 63.3333, 38.3333, 58.3333, 65.6667]


def test_flag_by_season(panel):
    # Maha: 100 120 20 110, mean 87.5, sample std 45.7347: below 41.77 -> 20.  Yala: 40 50 45 42, mean 44.25, std 4.3493: below 39.90 -> none
    out = FE.anomaly_flag(panel, "rain", ["season"]).where("drought_flag = 1").collect()
    assert [(r.year, r.season, r.rain) for r in out] == [(2003, "Maha", 20.0)]


def test_split_and_scaling(panel):
    d = SP.split_chrono(panel, ["year", "season_code"], SPEC.ratio)  # floor(8 * 0.85) = 6 training rows
    assert {r.split: r["count"] for r in d.groupBy("split").count().collect()} == {"train": 6, "test": 2}
    train = F.col("split") == "train"
    scaled = SP.scale_apply(d, SP.scale_fit(d, ["target"], where=train), ["target"]).orderBy("year", "season_code").collect()
    # training targets 10 4 12 6 8 5: mean 7.5, population variance (6.25 + 12.25 + 20.25 + 2.25 + 0.25 + 6.25) / 6 = 47.5 / 6
    sd = (47.5 / 6) ** 0.5
    assert [r.target_scaled for r in scaled] == pytest.approx([(t - 7.5) / sd for *_, t in ROWS])


def test_ols_coefficients(spark):
    # y = 3 + 2a - b exactly
    rows = [(a, b, 3 + 2 * a - b) for a in (0.0, 1.0, 2.0, 5.0) for b in (0.0, 1.0, 4.0)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    model = M.ols(["a", "b"], "y").fit(df)
    assert [*model.stages[-1].coefficients] == pytest.approx([2.0, -1.0]) and model.stages[-1].intercept == pytest.approx(3.0)
    # residuals of a noisy target are orthogonal to every input
    noisy = df.withColumn("y", F.col("y") + F.sin(F.col("a") * 7 + F.col("b")))
    out = M.ols(["a", "b"], "y").fit(noisy).transform(noisy)
    e = F.col("y") - F.col(M.PRED)
    r = out.agg(F.sum(e), F.sum(e * F.col("a")), F.sum(e * F.col("b"))).first()
    assert [*r] == pytest.approx([0.0, 0.0, 0.0], abs=1e-9)


def test_importances_sum_to_one(spark):
    rows = [(float(i % 7), float(i % 11), float(i % 7) * 3 + (i % 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    model = M.random_forest(["a", "b"], "y", num_trees=10).fit(df)
    got = M.impurity_importance(spark, model, ["a", "b"]).collect()
    assert sum(r.importance for r in got) == pytest.approx(1.0)


def test_saved_model_predicts_the_same(spark, tmp_path):
    from pyspark.ml import PipelineModel

    df = spark.createDataFrame([(float(i), float(i) * 2 + 1) for i in range(20)], "a double, y double")
    model = M.ols(["a"], "y").fit(df)
    model.write().overwrite().save(str(tmp_path / "ols"))
    again = [r[M.PRED] for r in PipelineModel.load(str(tmp_path / "ols")).transform(df).orderBy("a").collect()]
    assert again == [r[M.PRED] for r in model.transform(df).orderBy("a").collect()]
    assert again[:5] == pytest.approx([1.0, 3.0, 5.0, 7.0, 9.0]) and all(p > 0 for p in again)
