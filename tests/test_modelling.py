"""Grid search over expanding folds, refit, leaderboard and bundle on a small series."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import ml as M

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=120), rng.normal(size=120)
    y = 5 + 2 * a - b + rng.normal(scale=0.1, size=120)
    rows = [(i, float(x), float(z), float(t), "train" if i < 102 else "test") for i, (x, z, t) in enumerate(zip(a, b, y, strict=True))]
    return spark.createDataFrame(rows, "ordinal int, a double, b double, y double, split string").repartition(3).cache()


def test_full_grids():
    assert {k: len(M.grid(v)) for k, v in M.GRIDS.items()} == {"random_forest": 45, "boosted_trees": 27, "mlp": 18}


def test_folds_are_ordinal_ranges(series):
    seen = []

    def fit(train, **kw):
        lo, hi, n = train.agg(F.min("ordinal"), F.max("ordinal"), F.count(F.lit(1))).first()
        mean = train.agg(F.avg("y")).first()[0]
        seen.append((lo, hi, n))
        return lambda rows: rows.withColumn(M.PRED, F.lit(mean))

    base = series.where("split = 'train'")
    out = M.grid_search(base, fit, [{"x": 1}], "y", n_folds=5, parallelism=1).orderBy("fold").collect()
    # 102 rows, blocks of 17: training rows end before 17, 34, 51, 68, 85
    assert seen == [(0, 16, 17), (0, 33, 34), (0, 50, 51), (0, 67, 68), (0, 84, 85)]
    y = {r.ordinal: r.y for r in base.collect()}
    for r in out:
        start = 17 * (r.fold + 1)
        m = np.mean([y[i] for i in range(start)])
        assert r.rmse == pytest.approx(np.sqrt(np.mean([(y[i] - m) ** 2 for i in range(start, start + 17)])))


def test_tune_refits_the_best(series):
    base = series.where("split = 'train'")
    predict, best, scores = M.tune(base, "random_forest", FEATURES, "y", {"num_trees": [5], "max_depth": [1, 6], "min_leaf": [1]}, n_folds=3)
    assert best["max_depth"] == 6 and scores.count() == 6
    means = {json.loads(r.params)["max_depth"]: r.cv_rmse for r in M.mean_scores(scores).collect()}
    assert means[6] < means[1]
    e = F.col("y") - F.col(M.PRED)
    assert predict(base).agg(F.sqrt(F.avg(e * e))).first()[0] < means[6]


def test_leaderboard_and_bundle(spark, series, tmp_path):
    train = series.where("split = 'train'")
    models = {
        "ols": M.ols(FEATURES, "y").fit(train), "random_forest": M.random_forest(FEATURES, "y", num_trees=5).fit(train),
        "boosted_trees": M.boosted_trees(FEATURES, "y", n_iter=3).fit(train),
        "mlp": M.NeuralModel.fit(train, FEATURES, "y", hidden=(4,), max_iter=15),
    }
    scored = [M.scored(n, m.transform(series), M.PRED, "y", keys=["ordinal"]) for n, m in models.items()]
    scored = scored[0].unionByName(scored[1]).unionByName(scored[2]).unionByName(scored[3])
    board = M.metrics_wide(scored.drop("ordinal"))
    ranked = [r.model for r in M.rank_models(board).collect()]
    assert ranked[0] == "ols" and sorted(ranked) == sorted(models)
    table = M.pred_vs_actual(scored, ["ordinal"], list(models))
    assert table.count() == 18 and set(models) <= set(table.columns)
    M.save_bundle(spark, str(tmp_path), models, FEATURES, board)
    again, features, metrics, best = M.load_bundle(spark, str(tmp_path))
    assert features == FEATURES and best == "ols" and metrics.count() == 4
    first = series.orderBy("ordinal").limit(5)
    for name, m in models.items():
        old, new = ([r[M.PRED] for r in x.transform(first).orderBy("ordinal").collect()] for x in (m, again[name]))
        assert old == pytest.approx(new) and len(new) == 5


def test_queries_search_the_full_grids_and_rank_the_refitted(spark, monkeypatch, tmp_path):
    from conftest import SF_SMALL
    from panelkit.operators import grids as G
    from panelkit.plans import catalog_model as Q
    from panelkit.plans.registry import QUERIES

    fitted = []

    def scores(combos):
        rows = [(i, json.dumps(c, sort_keys=True), 0, float(len(combos) - i)) for i, c in enumerate(combos)]
        return spark.createDataFrame(rows, G.SCORES)

    def trainer(family, features, label):
        def fit(train, **kw):
            fitted.append((family, kw))
            return M.ols(features, label).fit(train)
        return fit

    net = M.NeuralModel.fit(Q.feature_table(spark, SF_SMALL).where("split = 'train'"), Q.FEATS, Q.LABEL, hidden=(2,), max_iter=2)
    monkeypatch.setattr(G, "network_grid", lambda base, f, y, combos, n: (scores(combos), {len(combos) - 1: net}))
    monkeypatch.setattr(G, "ensemble_grid", lambda base, family, f, y, combos, scratch, n, store: scores(combos))
    monkeypatch.setattr(M, "trainer", trainer)
    monkeypatch.setattr(Q, "checkpoint_dir", lambda s: str(tmp_path))
    monkeypatch.setattr(G.Store, "path", lambda self, name: f"{tmp_path}/{name}")  # a store of this test's own
    for name, family in [("cv_grid_search", "random_forest"), ("cv_grid_boosted_trees", "boosted_trees"), ("cv_grid_mlp", "mlp")]:
        got = {r.params for r in QUERIES[name](spark, SF_SMALL).collect()}
        assert got == {json.dumps(c, sort_keys=True) for c in M.grid(M.GRIDS[family])}
    assert QUERIES["ml_leaderboard"](spark, SF_SMALL).count() == 4
    # each family searched once, its best (here the last) combination refitted
    assert fitted == [(k, M.grid(M.GRIDS[k])[-1]) for k in ("random_forest", "boosted_trees")]


def test_ols_folds_from_one_pass(series):
    got = M.ols_folds(series, FEATURES, "y", n_folds=4).orderBy("fold").collect()
    rows = sorted((r.ordinal, r.a, r.b, r.y) for r in series.collect())
    x = np.array([[1.0, a, b] for _, a, b, _ in rows])
    y = np.array([r[3] for r in rows])
    for r, start in zip(got, (24, 48, 72, 96, 120), strict=True):
        beta = np.linalg.lstsq(x[:start], y[:start], rcond=None)[0]
        test = slice(start, start + 24) if start < 120 else slice(0, 120)
        assert r.n_train == start and r.coefficients == pytest.approx(beta.tolist(), rel=1e-9)
        assert r.rmse == pytest.approx(np.sqrt(np.mean((x[test] @ beta - y[test]) ** 2)), rel=1e-7)
    again = M.ols(FEATURES, "y").fit(series).stages[-1]
    assert got[-1].coefficients == pytest.approx([again.intercept, *again.coefficients], rel=1e-8)


def test_scenario_space_runs_in_slices(spark):
    from panelkit.operators import scenario as SC

    seasons, steps = {"Maha": "first", "Yala": "second"}, {"rainfall": 3, "sown": 2}
    assert SC.space_size(seasons, steps) == 12
    rows = [r.asDict() for r in SC.scenario_space(spark, seasons, steps, fixed={"lag1": 7.0}).orderBy("scenario").collect()]
    assert [(r["season"], r["rainfall"], r["sown"]) for r in rows] == [
        (s, w, a) for a in (200.0, 2000.0) for w in (200.0, 1600.0, 3000.0) for s in ("Maha", "Yala")]
    assert {(r["season"], r["temperature"], r["gdp"], r["inflation"], r["ratio"], r["lag1"]) for r in rows} == {
        ("Maha", 26.5, 85.0, 5.5, 0.95, 7.0), ("Yala", 28.8, 85.0, 5.5, 0.95, 7.0)}
    parts = [r.asDict() for a in (0, 5, 10) for r in SC.scenario_space(spark, seasons, steps, fixed={"lag1": 7.0}, start=a, stop=a + 5).collect()]
    assert sorted(parts, key=lambda r: r["scenario"]) == rows
