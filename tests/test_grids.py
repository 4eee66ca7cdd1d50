"""Grids in few passes: the batched networks against single fits, staged errors against fits of that length and depth."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import grids as G
from panelkit.operators import ml as M

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=120), rng.normal(size=120)
    y = 5 + 2 * a - b + a * b + rng.normal(scale=0.1, size=120)
    rows = [(i + 3, float(x), float(z), float(t)) for i, (x, z, t) in enumerate(zip(a, b, y, strict=True))]
    return spark.createDataFrame(rows, "ordinal int, a double, b double, y double").repartition(3).cache()


def rmse(model, rows):
    e = F.col("y") - F.col(M.PRED)
    return model.transform(rows).agg(F.sqrt(F.avg(e * e))).first()[0]


@pytest.mark.parametrize("block", [1 << 16, 50])
def test_networks_of_a_grid_equal_single_fits(series, monkeypatch, block):
    monkeypatch.setattr(G, "ROWS_PER_PARTITION", block)
    combos = M.grid({"hidden": [(4,), (3, 2)], "alpha": [0.001, 0.1], "rate": [0.05]})
    scores, models = G.network_grid(series, FEATURES, "y", combos, n_folds=3, max_iter=12, patience=3)
    got = {(r.combo, r.fold): r.rmse for r in scores.collect()}
    assert len(got) == 12 and set(models) == {0, 1, 2, 3}
    starts = G.fold_starts(3, 120, 3)
    assert starts == [33, 63, 93]
    for ci, f in ((0, 0), (3, 2)) if block > 100 else ((2, 1),):
        one = M.NeuralModel.fit(series.where(F.col("ordinal") < starts[f]), FEATURES, "y", max_iter=12, patience=3, **combos[ci])
        test = series.where((F.col("ordinal") >= starts[f]) & (F.col("ordinal") < starts[f] + 30))
        assert got[ci, f] == pytest.approx(rmse(one, test), rel=1e-9)
    if block > 100:
        whole = M.NeuralModel.fit(series, FEATURES, "y", max_iter=12, patience=3, **combos[1])
        assert rmse(models[1], series) == pytest.approx(rmse(whole, series), rel=1e-9)


def test_passes_of_one_job_equal_a_job_each(series):
    combos = M.grid({"hidden": [(4,), (3, 2)], "alpha": [0.01], "rate": [0.05, 0.2]})
    found = []
    for steps in (1, 7, 100):
        scores, models = G.network_grid(series, FEATURES, "y", combos, n_folds=2, max_iter=30, patience=2, steps=steps)
        found.append((sorted(map(tuple, scores.collect())), [models[i].net["weights"].tolist() for i in sorted(models)]))
    assert found[0] == found[1] == found[2]


def test_prefix_of_boosting_equals_a_shorter_fit(spark, series, tmp_path):
    long = M.boosted_trees(FEATURES, "y", n_iter=6, max_depth=3).fit(series)
    trees = G.node_arrays(spark, long, str(tmp_path / "m"))
    got = G.staged_errors(series, trees, FEATURES, "y", [2, 6], [None], list(long.stages[-1].treeWeights))
    assert got[6, None] == pytest.approx(rmse(long, series))
    assert got[2, None] == pytest.approx(rmse(M.boosted_trees(FEATURES, "y", n_iter=2, max_depth=3).fit(series), series))


def test_cut_forest_equals_a_lower_one(spark, series, tmp_path):
    deep = M.random_forest(FEATURES, "y", num_trees=5, max_depth=None).fit(series)
    trees = G.node_arrays(spark, deep, str(tmp_path / "m"))
    got = G.staged_errors(series, trees, FEATURES, "y", [1, 5], [2, None])
    assert got[5, None] == pytest.approx(rmse(deep, series))
    assert got[5, 2] == pytest.approx(rmse(M.random_forest(FEATURES, "y", num_trees=5, max_depth=2).fit(series), series))
    one = G.staged_values({**trees, "first": trees["first"][:1]}, np.zeros((1, 2)), [None])[0]
    assert one.shape == (1, 1)


def test_forest_is_scored_without_collecting_its_trees(spark, series, tmp_path, monkeypatch):
    deep = M.random_forest(FEATURES, "y", num_trees=5, max_depth=None).fit(series)
    expected = G.staged_errors(series, G.node_arrays(spark, deep, str(tmp_path / "m")), FEATURES, "y", [1, 5], [2, None])
    got = G.forest_errors(series, G._node_table(spark, str(tmp_path / "m")), FEATURES, "y", [1, 5], [2, None])
    assert got == pytest.approx(expected, rel=1e-12)
    monkeypatch.setattr(G, "node_arrays", None)
    scores = G.ensemble_grid(series, "random_forest", FEATURES, "y", [{"num_trees": 2, "max_depth": None, "min_leaf": 1}], lambda name: str(tmp_path / name), n_folds=1)
    assert scores.count() == 1


def test_ensemble_grid_scores_every_combination(series, tmp_path):
    combos = M.grid({"num_trees": [2, 4], "max_depth": [1, None], "min_leaf": [1, 3]})
    count = iter(range(100))
    scores = G.ensemble_grid(series, "random_forest", FEATURES, "y", combos, lambda name: str(tmp_path / f"{name}{next(count)}"), n_folds=2)
    got = {(r.combo, r.fold): r.rmse for r in scores.collect()}
    assert len(got) == 16 and next(count) == 4  # two settings fitted on two folds
    start = G.fold_starts(3, 120, 2)[1]
    deep = [ci for ci, c in enumerate(combos) if c == {"num_trees": 4, "max_depth": None, "min_leaf": 3}][0]
    one = M.random_forest(FEATURES, "y", num_trees=4, max_depth=None, min_leaf=3).fit(series.coalesce(1).where(F.col("ordinal") < start))
    assert got[deep, 1] == pytest.approx(rmse(one, series.where(F.col("ordinal") >= start)))


def test_search_goes_on_where_it_was(spark, series, tmp_path, monkeypatch):
    store = G.Store(series, str(tmp_path), ["ordinal", "y", "a", "b"])
    assert store.folder != G.Store(series.where("ordinal > 3"), str(tmp_path), ["ordinal", "y", "a", "b"]).folder
    params = {"n_iter": [1, 2], "max_depth": [2], "rate": [0.1]}
    count = iter(range(100))
    model, best, scores = G.tuned(series, "boosted_trees", FEATURES, "y", store, lambda n: str(tmp_path / f"{n}{next(count)}"), params, 2)
    assert scores.count() == 4 and best["n_iter"] == 2

    def stop(*a, **k):
        raise AssertionError("fitted again")

    monkeypatch.setattr(M, "trainer", stop)
    again = G.tuned(series, "boosted_trees", FEATURES, "y", store, None, params, 2)
    assert again[1] == best and rmse(again[0], series) == pytest.approx(rmse(model, series))
    rest = G.ensemble_grid(series, "boosted_trees", FEATURES, "y", M.grid(params), None, 2, store=store)
    assert sorted(map(tuple, rest.collect())) == sorted(map(tuple, scores.collect()))


BOOSTED = [{"n_iter": 7, "max_depth": 3, "rate": 0.1}, {"n_iter": 4, "max_depth": 6, "rate": 0.3}, {"n_iter": 3, "max_depth": 4, "rate": 0.1, "min_leaf": 5}]


def test_ensembles_grown_together_equal_single_fits(series):
    one = series.coalesce(1).cache()
    wanted = [(BOOSTED[0], 123), (BOOSTED[1], 123), (BOOSTED[2], 43)]
    got = G.boosted_grid(one, FEATURES, "y", wanted)
    again = G.boosted_grid(one, FEATURES, "y", wanted, steps=2)  # over several jobs
    x = one.orderBy("ordinal").toPandas()[FEATURES].to_numpy()
    for (trees, weights), (same, _), (c, end) in zip(got, again, wanted, strict=True):
        model = M.boosted_trees(FEATURES, "y", **c).fit(one.where(F.col("ordinal") < end))
        assert weights == list(model.stages[-1].treeWeights)
        assert {k: z.tolist() for k, z in trees.items()} == {k: z.tolist() for k, z in same.items()}
        found = G.staged_values(trees, x, [None])[0] @ np.array(weights)
        expected = [r[0] for r in model.transform(one).orderBy("ordinal").select(M.PRED).collect()]
        assert found.tolist() == pytest.approx(expected, rel=1e-9)


def test_ensembles_of_many_partitions_equal_those_of_one(spark, monkeypatch):
    """Whole numbers, so that sums don't depend on the order; weights 1 and 0.5, so that targets stay exact for some rounds."""
    rng = np.random.default_rng(8)
    x = rng.integers(0, 50, size=(300, 2))
    rows = [(i, float(a), float(b), float(a * b % 17 + 64 * (a > 20))) for i, (a, b) in enumerate(x.tolist())]
    base = spark.createDataFrame(rows, "ordinal int, a double, b double, y double").repartition(4).cache()
    settings = [({"n_iter": 2, "max_depth": 2, "rate": 0.5}, 200), ({"n_iter": 3, "max_depth": 2, "rate": 0.25}, 300)]
    whole = G.boosted_grid(base, FEATURES, "y", settings)
    monkeypatch.setattr(G, "ROWS_PER_PARTITION", 80)
    monkeypatch.setattr(G, "KEEP", 2)
    monkeypatch.setattr(G, "SLOTS", 2)
    for (a, w), (b, v) in zip(whole, G.boosted_grid(base, FEATURES, "y", settings), strict=True):
        assert w == v and {k: z.tolist() for k, z in a.items() if k != "value"} == {k: z.tolist() for k, z in b.items() if k != "value"}
        assert b["value"].tolist() == pytest.approx(a["value"].tolist(), rel=1e-9, abs=1e-9)


def test_boosted_grid_trains_no_single_fits(series, monkeypatch):
    """Every combination and fold is scored without a fit of its own (about 1,000 jobs each)."""
    monkeypatch.setattr(M, "trainer", None)
    combos = M.grid({"n_iter": [2, 3], "max_depth": [2], "rate": [0.1, 0.2]})
    scores = {(r.combo, r.fold): r.rmse for r in G.ensemble_grid(series, "boosted_trees", FEATURES, "y", combos, None, n_folds=2).collect()}
    assert len(scores) == 8
    start = G.fold_starts(3, 120, 2)[1]
    one = M.boosted_trees(FEATURES, "y", **combos[3]).fit(series.coalesce(1).where(F.col("ordinal") < start))
    assert scores[3, 1] == pytest.approx(rmse(one, series.where(F.col("ordinal") >= start)))


@pytest.mark.parametrize("block", [1 << 16, 40])
def test_boosted_grid_scores_where_it_grows(series, monkeypatch, block):
    """The errors of the grown trees' prefixes without a job per ensemble; the same over several jobs and many partitions."""
    one, lengths = series.coalesce(1).cache(), [1, 3]
    wanted = [({"n_iter": 3, "max_depth": 2, "rate": 0.5}, 63), ({"n_iter": 3, "max_depth": 3, "rate": 0.2}, 93)]
    expected = [G.staged_errors(one.where((F.col("ordinal") >= end) & (F.col("ordinal") < end + 30)), trees, FEATURES, "y", lengths, [None], weights)
                for (trees, weights), (_, end) in zip(G.boosted_grid(one, FEATURES, "y", wanted), wanted, strict=True)]
    monkeypatch.setattr(G, "ROWS_PER_PARTITION", block)
    if block > 100:
        monkeypatch.setattr(G, "staged_errors", None)
    for steps in (None, 2) if block > 100 else (None,):
        got = G.boosted_grid(series, FEATURES, "y", wanted, steps=steps, tests=[(end, end + 30, lengths) for _, end in wanted])
        for a, b in zip(got, expected, strict=True):
            assert a == pytest.approx(b, rel=1e-6)


def test_candidate_thresholds_and_missing_values(spark):
    assert G.thresholds(np.array([1.0, 3.0, 1.0, 0.0]), 4, 31).tolist() == [0.5, 2.0]
    assert G.thresholds(np.array([2.0, 2.0]), 2, 31).tolist() == []
    assert G.thresholds(np.arange(8.0), 8, 3).tolist() == [1.5, 3.5, 5.5]
    rows = spark.createDataFrame([(0, 1.0, None), (1, 2.0, 3.0)], "ordinal int, a double, y double")
    with pytest.raises(ValueError, match="1 rows to fit"):
        G.boosted_grid(rows, ["a"], "y", [({"n_iter": 1}, 2)])
