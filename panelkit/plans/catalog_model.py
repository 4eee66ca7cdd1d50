"""Queries for splitting, scaling, folds, models and scenario scoring
(SURVEY 2.10, 2.11).

Models run on the panel feature table.  That table is built once per
session and written to the shared scratch folder, so the many model queries
read a materialised table instead of re-running the clean + feature plan."""

from __future__ import annotations

import threading

from pyspark.sql import functions as F

from ..operators import grids as G
from ..operators import joins as J
from ..operators import ml as M
from ..operators import scenario as SC
from ..operators import split as SP
from ..operators.ordinal import with_ordinal
from ..session import checkpoint_dir
from ..sources import readers as R
from . import bindings as B
from . import flows as FL
from .registry import query, round_half_up, rounded, rsql
from .sql_twins import clean_sql, features_sql

W = B.with_ctes
CONT = FL.PANEL.continuous
FEATS = FL.FEATURES
LABEL = "target"

_lock = threading.Lock()
_tables: dict = {}
_tune_lock = threading.Lock()


def feature_table(spark, sf):
    """Clean + feature table, materialised once per (application, input)."""
    key = (spark.sparkContext.applicationId, sf)
    with _lock:
        if key not in _tables:
            path = R.scratch_path(spark, "features")
            R.write_table(FL.features(FL.clean(B.panel(spark, sf))), path)
            _tables[key] = path
    return spark.read.parquet(_tables[key])


# ---------------------------------------------------------------- split / scale / folds
_ORD_ORDERS = "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS ordinal, COUNT(*) OVER () AS n FROM orders"


@query("split_chrono", f"SELECT o_orderkey, ordinal, CASE WHEN ordinal < floor(n * 0.85) THEN 'train' ELSE 'test' END AS split FROM ({_ORD_ORDERS})")
def split_chrono(spark, sf):
    o = B.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return SP.split_chrono(o, ["o_orderdate", "o_orderkey"], 0.85).select("o_orderkey", "ordinal", "split")


_HALF_ORD = W("""SELECT year, season, row_number() OVER (ORDER BY year, CASE season WHEN 'H1' THEN 0 WHEN 'H2' THEN 1 END) - 1 AS ordinal,
    COUNT(*) OVER () AS n FROM half""", half=B.HALF_SQL)


def _half_split(spark, sf):
    h = B.half(spark, sf).withColumn("__code", F.when(F.col("season") == "H1", 0).when(F.col("season") == "H2", 1))
    return SP.split_chrono(h, ["year", "__code"], 0.85)


@query("split_chrono_half", f"SELECT year, season, ordinal, CASE WHEN ordinal < floor(n * 0.85) THEN 'train' ELSE 'test' END AS split FROM ({_HALF_ORD})")
def split_chrono_half(spark, sf):
    return _half_split(spark, sf).select("year", "season", "ordinal", "split")


@query("split_year", f"SELECT max(year) AS split_year FROM ({_HALF_ORD}) WHERE ordinal < floor(n * 0.85)")
def split_year(spark, sf):
    return SP.split_year(_half_split(spark, sf))


@query("scale_fit", rsql(clean_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c}__m AS mean, {c}__s AS std FROM c_par" for c in CONT)), ["mean", "std"]))
def scale_fit(spark, sf):
    c = FL.clean(B.panel(spark, sf))
    return rounded(SP.scale_fit(c, CONT, where=F.col("split") == "train"))


@query("scale_apply", rsql(clean_sql("SELECT series, year, month, " + ", ".join(
    f"(p0.{c} - c_par.{c}__m) / c_par.{c}__s AS {c}_scaled" for c in CONT) + " FROM panel p0, c_par"),
    [f"{c}_scaled" for c in CONT]))
def scale_apply(spark, sf):
    p = B.panel(spark, sf)
    c = FL.clean(p)
    params = SP.scale_fit(c, CONT, where=F.col("split") == "train")
    out = SP.scale_apply(p, params, CONT)
    return rounded(out.select("series", "year", "month", *[f"{x}_scaled" for x in CONT]))


@query("cv_expanding_folds", f"""SELECT f AS fold, CASE WHEN ordinal < n - 5 * (n // 6) + f * (n // 6) THEN 'train' ELSE 'test' END AS role, o_orderkey
    FROM ({_ORD_ORDERS}), range(0, 5) t(f)
    WHERE ordinal < n - 5 * (n // 6) + f * (n // 6) + (n // 6)""")
def cv_expanding_folds(spark, sf):
    o = with_ordinal(B.table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])
    return SP.expanding_folds(o, "ordinal", 5).select(F.col("fold").cast("long").alias("fold"), "role", "o_orderkey")


# ---------------------------------------------------------------- metrics on naive predictors (exact SQL twins)
_NAIVE = {"naive_lag1": "yield_lag1", "naive_lag2": "yield_lag2"}


def _naive_scores(spark, sf):
    f = feature_table(spark, sf)
    parts = [M.scored(m, f, c, LABEL, keys=["series", "year", "month"]) for m, c in _NAIVE.items()]
    return parts[0].unionByName(parts[1])


_SCORES_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS model, split, series, year, month, target AS y, {c} AS pred FROM features" for m, c in _NAIVE.items())
_METRICS_SQL = f"""SELECT model, split, COUNT(*) AS n, sqrt(avg((y - pred) * (y - pred))) AS rmse, avg(abs(y - pred)) AS mae,
    CASE WHEN var_pop(y) = 0 THEN CAST(sum((y - pred) * (y - pred)) = 0 AS DOUBLE)
         ELSE 1 - avg((y - pred) * (y - pred)) / var_pop(y) END AS r2 FROM ({_SCORES_SQL}) GROUP BY 1, 2"""
_WIDE_SQL = f"""SELECT te.model, te.rmse AS test_rmse, te.mae AS test_mae, te.r2 AS test_r2, tr.rmse AS train_rmse, tr.r2 AS train_r2,
    te.rmse - tr.rmse AS gap FROM (SELECT * FROM m WHERE split = 'test') te FULL JOIN (SELECT * FROM m WHERE split = 'train') tr USING (model)"""


@query("ml_metrics", rsql(features_sql(_METRICS_SQL), ["rmse", "mae", "r2"]))
def ml_metrics(spark, sf):
    return rounded(M.metrics(_naive_scores(spark, sf)))


@query("ml_rank", rsql(features_sql(_WIDE_SQL, m=_METRICS_SQL),
                       ["test_rmse", "test_mae", "test_r2", "train_rmse", "train_r2", "gap"]))
def ml_rank(spark, sf):
    return rounded(M.rank_models(M.metrics_wide(_naive_scores(spark, sf))))


@query("best_row", rsql(features_sql(f"SELECT * FROM ({_WIDE_SQL}) ORDER BY test_rmse, model LIMIT 1", m=_METRICS_SQL),
                        ["test_rmse", "test_mae", "test_r2", "train_rmse", "train_r2", "gap"]))
def best_row(spark, sf):
    from ..operators.shaping import best_row as _best
    return rounded(_best(M.rank_models(M.metrics_wide(_naive_scores(spark, sf))), "test_rmse"))


@query("ml_pred_vs_actual", rsql(features_sql("""SELECT series, year, month, CAST(year AS VARCHAR) || ' ' || season AS label,
    yield_lag1 AS naive_lag1, yield_lag2 AS naive_lag2, target AS actual FROM features WHERE split = 'test'"""),
    ["naive_lag1", "naive_lag2", "actual"]))
def ml_pred_vs_actual(spark, sf):
    f = feature_table(spark, sf).withColumn("label", F.concat_ws(" ", F.col("year").cast("string"), F.col("season")))
    parts = [M.scored(m, f, c, LABEL, keys=["series", "year", "month", "label"]) for m, c in _NAIVE.items()]
    t = M.pred_vs_actual(parts[0].unionByName(parts[1]), ["series", "year", "month", "label"], list(_NAIVE))
    return rounded(t)


# ---------------------------------------------------------------- model fits
@query("ml_ols", rsql(features_sql("""SELECT regr_slope(target, harvested_scaled) AS slope, regr_intercept(target, harvested_scaled) AS intercept
    FROM features WHERE split = 'train'"""), ["slope", "intercept"]))
def ml_ols(spark, sf):
    f = feature_table(spark, sf)
    return rounded(M.one_feature_ols(f.where(F.col("split") == "train"), "harvested_scaled", LABEL))


# One setting per family for the queries that fit a single family without a search.
SETTINGS = {
    "ols": {}, "random_forest": {"num_trees": 100, "max_depth": 8},
    "boosted_trees": {"n_iter": 50, "max_depth": 3, "rate": 0.1, "min_leaf": 2},
    "mlp": {"hidden": (64, 32), "alpha": 1e-3, "rate": 0.01},
}
_MAKE = {"ols": M.ols, "random_forest": M.random_forest, "boosted_trees": M.boosted_trees}


def _fit(f, family):
    train = f.where(F.col("split") == "train")
    if family == "mlp":
        return M.NeuralModel.fit(train, FEATS, LABEL, **SETTINGS["mlp"])
    return _MAKE[family](FEATS, LABEL, **SETTINGS[family]).fit(train)


def _scores(f, models, keys=()):
    parts = [M.scored(name, m.transform(f), M.PRED, LABEL, keys=keys) for name, m in models.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _one(spark, sf, family):
    f = feature_table(spark, sf)
    return M.metrics_wide(_scores(f, {family: _fit(f, family)}))


def tuned(spark, sf, family):
    """(model, best parameters, scores): the family's full grid over expanding folds and its best combination refitted on the
    training rows.  Results are kept below the shared folder under a fingerprint of those rows."""
    f = feature_table(spark, sf).where(F.col("split") == "train")
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    with _tune_lock:
        store = G.Store(f, root, ["ordinal", LABEL, *FEATS])
        return G.tuned(f, family, FEATS, LABEL, store, lambda name: R.scratch_path(spark, name))


def _all(spark, sf):
    """The feature table and the four models: OLS, which has nothing to tune, and the tuned model of each other family."""
    f = feature_table(spark, sf)
    return f, {"ols": _fit(f, "ols"), **{name: tuned(spark, sf, name)[0] for name in M.GRIDS}}


@query("ml_ols_full")
def ml_ols_full(spark, sf):
    return _one(spark, sf, "ols")


_TERMS = ["intercept", *FEATS, LABEL]


def _gram_sql():
    expr = {"intercept": "CAST(1 AS DOUBLE)"}
    sums = ", ".join(f"sum({expr.get(a, a)} * {expr.get(b, b)}) AS s{i}_{j}" for i, a in enumerate(_TERMS) for j, b in enumerate(_TERMS) if j >= i)
    some = " AND ".join(f"{c} IS NOT NULL" for c in _TERMS[1:])
    cells = " UNION ALL ".join(f"SELECT split, n, '{a}' AS term_a, '{b}' AS term_b, s{i}_{j} / nullif(sqrt(s{i}_{i} * s{j}_{j}), 0) AS cosine FROM g"
                               for i, a in enumerate(_TERMS) for j, b in enumerate(_TERMS) if j >= i)
    return features_sql(cells, g=f"SELECT split, COUNT(*) AS n, {sums} FROM features WHERE {some} GROUP BY split")


@query("ml_gram", rsql(_gram_sql(), ["cosine"]))
def ml_gram(spark, sf):
    """Sufficient statistics of the linear fit by split: the cosine of every two terms."""
    g = M.gram(feature_table(spark, sf), FEATS, LABEL, F.col("split")).withColumnRenamed("block", "split")
    k = len(_TERMS)
    at = {}
    for i in range(k):
        for j in range(i, k):
            at[i, j] = len(at)
    p = F.col("products")
    cells = F.explode(F.array(*[F.struct(F.lit(_TERMS[i]).alias("term_a"), F.lit(_TERMS[j]).alias("term_b"), F.try_divide(
        p[n], F.sqrt(p[at[i, i]] * p[at[j, j]])).alias("cosine")) for (i, j), n in at.items()]))
    return rounded(g.select("split", "n", cells.alias("c")).select("split", "n", "c.*"))


@query("ml_ols_residuals", rsql(features_sql(" UNION ALL ".join(
    f"SELECT '{t}' AS term, (SELECT COUNT(*) FROM features WHERE split = 'train') AS n, CAST(0 AS DOUBLE) AS cosine" for t in _TERMS[:-1])), ["cosine"]))
def ml_ols_residuals(spark, sf):
    """The residuals of the full linear fit on its training rows are orthogonal to every term (cosine 0)."""
    train = feature_table(spark, sf).where(F.col("split") == "train")
    beta = M.ols_folds(train, FEATS, LABEL).where("fold = 5").first().coefficients
    e = F.col(LABEL) - F.lit(beta[0])
    for b, c in zip(beta[1:], FEATS, strict=True):
        e = e - F.lit(b) * F.col(c)
    terms = [F.lit(1.0), *[F.col(c).cast("double") for c in FEATS]]
    sums = train.withColumn("__e", e).agg(F.count(F.lit(1)).alias("n"), *[
        F.coalesce(F.try_divide(F.sum(F.col("__e") * t), F.sqrt(F.sum(t * t) * F.sum(F.col(LABEL) * F.col(LABEL)))), F.lit(0.0)).alias(f"c{i}")
        for i, t in enumerate(terms)])
    cells = F.explode(F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"c{i}").alias("cosine")) for i, t in enumerate(_TERMS[:-1])]))
    return rounded(sums.select("n", cells.alias("c")).select("c.term", "n", "c.cosine"))


@query("cv_ols_folds")
def cv_ols_folds(spark, sf):
    """RMSE of the full linear fit on every expanding fold, from one pass."""
    return M.ols_folds(feature_table(spark, sf).where(F.col("split") == "train"), FEATS, LABEL).select("fold", "n_train", "rmse")


@query("ml_random_forest")
def ml_random_forest(spark, sf):
    return _one(spark, sf, "random_forest")


@query("ml_boosted_trees")
def ml_boosted_trees(spark, sf):
    return _one(spark, sf, "boosted_trees")


@query("ml_mlp")
def ml_mlp(spark, sf):
    return _one(spark, sf, "mlp")


@query("cv_grid_search")
def cv_grid_search(spark, sf):
    """Mean score over expanding folds of every combination of the forest's full grid."""
    return M.mean_scores(tuned(spark, sf, "random_forest")[2])


@query("cv_grid_boosted_trees")
def cv_grid_boosted_trees(spark, sf):
    return M.mean_scores(tuned(spark, sf, "boosted_trees")[2])


@query("cv_grid_mlp")
def cv_grid_mlp(spark, sf):
    return M.mean_scores(tuned(spark, sf, "mlp")[2])


@query("ml_leaderboard")
def ml_leaderboard(spark, sf):
    """The four tuned models on one holdout, best first."""
    f, models = _all(spark, sf)
    return M.rank_models(M.metrics_wide(_scores(f, models)))


@query("ml_holdout_predictions")
def ml_holdout_predictions(spark, sf):
    """Holdout rows: actual value and the four tuned models' predictions."""
    f, models = _all(spark, sf)
    keys = ["series", "year", "month"]
    return M.pred_vs_actual(_scores(f, models, keys), keys, list(models))


@query("ml_importance_impurity")
def ml_importance_impurity(spark, sf):
    return M.impurity_importance(spark, tuned(spark, sf, "random_forest")[0], FEATS)


@query("ml_importance_splits")
def ml_importance_splits(spark, sf):
    path = R.scratch_path(spark, "gbt-model")
    tuned(spark, sf, "boosted_trees")[0].write().overwrite().save(path)
    return M.split_importance(spark, path, FEATS)


@query("ml_save_load")
def ml_save_load(spark, sf):
    """All four tuned models, the feature order and the leaderboard written and read again; the best one predicts the first five rows."""
    f, models = _all(spark, sf)
    path = R.scratch_path(spark, "bundle")
    M.save_bundle(spark, path, models, FEATS, M.metrics_wide(_scores(f, models)))
    again, features, _, best = M.load_bundle(spark, path)
    rows = f.select("series", "year", "month", "ordinal", *features).orderBy("ordinal").limit(5)
    return again[best].transform(rows).select("series", "year", "month", F.lit(best).alias("model"), M.PRED)


# ---------------------------------------------------------------- scenarios
_DIMS = {"rainfall": "rainfall", "temperature": "temperature", "gdp": "gdp", "inflation": "inflation",
         "sown": "sown", "ratio": "ratio", "lag1": "production"}


def _ranges(spark, sf):
    p = B.panel(spark, sf).withColumn("ratio", F.try_divide(F.col("harvested"), F.col("sown")))
    aggs = [x for d, src in _DIMS.items() for x in (F.min(src).alias(f"{src}_lo"), F.max(src).alias(f"{src}_hi"))]
    return p.groupBy("season").agg(*aggs)


def _grid_sql():
    rng = ", ".join(f"min({s}) AS {s}_lo, max({s}) AS {s}_hi" for s in _DIMS.values())
    sel = ", ".join(f"{s}_lo + ({s}_hi - {s}_lo) * k{i} / 2.0 AS {d}" for i, (d, s) in enumerate(_DIMS.items()))
    joins = ", ".join(f"range(0, 3) t{i}(k{i})" for i in range(len(_DIMS)))
    return W(f"SELECT season, {sel} FROM r, {joins}",
             panel=B.PANEL_SQL,
             r=f"SELECT season, {rng} FROM (SELECT *, harvested / nullif(sown, 0) AS ratio FROM panel) GROUP BY season")


@query("scenario_grid", rsql(_grid_sql(), list(_DIMS)))
def scenario_grid(spark, sf):
    return rounded(SC.grid_from_ranges(_ranges(spark, sf), {d: s for d, s in _DIMS.items()}, steps=3))


_CUTS = {"H1": SC.DROUGHT_CUTOFFS["first"], "H2": SC.DROUGHT_CUTOFFS["second"]}
_SCEN_COLS = {"rainfall": "rainfall", "temperature": "temperature", "gdp": "gdp", "inflation": "inflation",
              "sown": "sown", "ratio": "harvest_efficiency", "lag1": "yield_lag1"}


def _scenario_feats(spark, sf):
    f = feature_table(spark, sf)
    params = SP.scale_fit(f, CONT, where=F.col("split") == "train")
    scen = f.select("series", "year", "month", "season", "split", LABEL, *[c for c in set(_SCEN_COLS.values())])
    return SC.scenario_features(scen, params, _SCEN_COLS, "season", "H1", _CUTS)


def _scen_feat_sql(body):
    scaled = ", ".join(
        f"({('sown * harvest_efficiency' if c == 'harvested' else c)} - p.{c}__m) / p.{c}__s AS {c}_scaled" for c in CONT)
    cte = f"""SELECT series, year, month, season, split, target, {scaled},
        CASE WHEN season = 'H1' THEN 1 ELSE 0 END AS season_binary, yield_lag1, yield_lag1 AS yield_lag2,
        rainfall AS rainfall_roll3, temperature AS temp_roll3, harvest_efficiency, sown * harvest_efficiency AS harvested_s,
        CAST(coalesce(rainfall < CASE season WHEN 'H1' THEN {_CUTS['H1']} WHEN 'H2' THEN {_CUTS['H2']} END, false) AS INT) AS drought_flag
        FROM features, c_par p"""
    inner = f"SELECT *, rainfall_scaled * temperature_scaled AS rain_x_temp, inflation_scaled * gdp_scaled AS inf_x_gdp FROM ({cte})"
    return features_sql(body, scen=inner)


_SPACE = {"rainfall": 7, "temperature": 3, "sown": 5, "ratio": 3}
_SEASONS = {"H1": "first", "H2": "second"}


def _space_sql(body):
    """``scen`` over the scenario space instead of the panel rows."""
    text, radix = _scen_feat_sql(body), 2
    cols = []
    for name, k in _SPACE.items():
        lo, hi = SC.RANGES[name]
        cols.append(f"{lo} + {hi - lo!r} * ((i // {radix}) % {k}) / {float(k - 1)} AS {_SCEN_COLS[name]}")
        radix *= k
    for name in ("gdp", "inflation"):
        cols.append(f"{SC.DEFAULTS[name]} AS {_SCEN_COLS[name]}")
    space = (f"SELECT i AS scenario, CASE WHEN i % 2 = 0 THEN 'H1' ELSE 'H2' END AS season, {', '.join(cols)}, "
             f"(SELECT arg_max(target, ordinal) FROM features) AS yield_lag1 FROM range(0, {radix}) t(i)")
    return text.replace("SELECT series, year, month, season, split, target,", "SELECT scenario, season,").replace("FROM features, c_par p", f"FROM ({space}), c_par p")


_SF_OUT = ["series", "year", "month", *FEATS]


@query("scenario_features", rsql(_scen_feat_sql(f"SELECT {', '.join(_SF_OUT)} FROM scen"),
                                 [c for c in FEATS if c not in ("season_binary", "drought_flag")]))
def scenario_features(spark, sf):
    return rounded(_scenario_feats(spark, sf).select(*_SF_OUT))


def _scored_scenarios(spark, sf):
    s = _scenario_feats(spark, sf)
    coef = M.one_feature_ols(feature_table(spark, sf).where(F.col("split") == "train"), "harvested_scaled", LABEL)
    return J.attach_row(s, coef).withColumn(
        "pred", F.col("intercept") + F.col("slope") * F.col("harvested_scaled")).withColumn(
        "harvested", F.col("sown") * F.col("harvest_efficiency"))


_COEF_SQL = "SELECT regr_slope(target, harvested_scaled) AS slope, regr_intercept(target, harvested_scaled) AS intercept FROM features WHERE split = 'train'"


@query("scenario_score", rsql(_scen_feat_sql(f"SELECT series, year, month, intercept + slope * harvested_scaled AS pred FROM scen, ({_COEF_SQL})"), ["pred"]))
def scenario_score(spark, sf):
    return rounded(_scored_scenarios(spark, sf).select("series", "year", "month", "pred"))


@query("scenario_score_model")
def scenario_score_model(spark, sf):
    f = feature_table(spark, sf)
    model = M.ols(FEATS, LABEL).fit(f.where(F.col("split") == "train"))
    return model.transform(_scenario_feats(spark, sf)).select("series", "year", "month", M.PRED)


_KPI_SQL = _scen_feat_sql(f"""SELECT series, year, month, pred * 1000.0 AS pred_tonnes, (pred - mean_target) / nullif(mean_target, 0) * 100 AS delta_pct,
    (pred * 1000.0) / nullif(harvested_s * 1000.0, 0) * 1000.0 AS kg_per_acre, harvest_efficiency * 100.0 AS efficiency_pct,
    CASE WHEN drought_flag = 1 THEN '{SC.RISK_DROUGHT}' ELSE '{SC.RISK_OK}' END AS risk_status,
    CASE WHEN drought_flag = 1 THEN '{SC.RISK_DROUGHT_NOTE}' ELSE '{SC.RISK_OK_NOTE}' END AS risk_note
    FROM (SELECT *, intercept + slope * harvested_scaled AS pred FROM scen, ({_COEF_SQL})) s
    JOIN (SELECT season, avg(target) AS mean_target FROM features GROUP BY season) USING (season)""")


# pred_tonnes is ~1e6: kept to 3 decimals (the same 10 significant digits as pred)
@query("scenario_kpis", rsql(rsql(_KPI_SQL, ["delta_pct", "kg_per_acre", "efficiency_pct"]), ["pred_tonnes"], 3))
def scenario_kpis(spark, sf):
    s = _scored_scenarios(spark, sf)
    hist = feature_table(spark, sf).groupBy("season").agg(F.avg(LABEL).alias("mean_target"))
    k = SC.kpis(s, hist, "season", "pred", "harvested", "harvest_efficiency")
    k = k.withColumn("pred_tonnes", round_half_up("pred_tonnes", 3))
    return rounded(k.select("series", "year", "month", "pred_tonnes", "delta_pct", "kg_per_acre", "efficiency_pct",
                            "risk_status", "risk_note"))


_SPACE_OUT = ["pred_tonnes", "delta_pct", "kg_per_acre", "efficiency_pct"]


@query("scenario_space_kpis", rsql(rsql(_space_sql(f"""SELECT scenario, season, pred * 1000.0 AS pred_tonnes,
    (pred - mean_target) / nullif(mean_target, 0) * 100 AS delta_pct, (pred * 1000.0) / nullif(harvested_s * 1000.0, 0) * 1000.0 AS kg_per_acre,
    harvest_efficiency * 100.0 AS efficiency_pct, CASE WHEN drought_flag = 1 THEN '{SC.RISK_DROUGHT}' ELSE '{SC.RISK_OK}' END AS risk_status
    FROM (SELECT *, intercept + slope * harvested_scaled AS pred FROM scen, ({_COEF_SQL})) s
    JOIN (SELECT season, avg(target) AS mean_target FROM features GROUP BY season) USING (season)"""), _SPACE_OUT[1:]), ["pred_tonnes"], 3))
def scenario_space_kpis(spark, sf):
    """The simulator's whole chain in bulk: its stated ranges and season defaults, the last observed production as the previous one,
    features with the stored scaling, score and figures."""
    f = feature_table(spark, sf)
    last = f.agg(F.max_by(LABEL, "ordinal").alias("v")).first().v
    space = SC.scenario_space(spark, _SEASONS, _SPACE, fixed={"lag1": last}).withColumnsRenamed(_SCEN_COLS)
    params = SP.scale_fit(f, CONT, where=F.col("split") == "train")
    s = SC.scenario_features(space, params, _SCEN_COLS, "season", "H1", _CUTS)
    coef = M.one_feature_ols(f.where(F.col("split") == "train"), "harvested_scaled", LABEL)
    s = J.attach_row(s, coef).withColumn("pred", F.col("intercept") + F.col("slope") * F.col("harvested_scaled")).withColumn(
        "harvested", F.col("sown") * F.col("harvest_efficiency"))
    k = SC.kpis(s, f.groupBy("season").agg(F.avg(LABEL).alias("mean_target")), "season", "pred", "harvested", "harvest_efficiency")
    k = k.withColumn("pred_tonnes", round_half_up("pred_tonnes", 3))
    return rounded(k.select("scenario", "season", *_SPACE_OUT, "risk_status"))


@query("scenario_best_model")
def scenario_best_model(spark, sf):
    """The panel's scenarios scored by the model of the tuned leaderboard that ranks first."""
    f, models = _all(spark, sf)
    best = M.rank_models(M.metrics_wide(_scores(f, models))).first().model
    return models[best].transform(_scenario_feats(spark, sf)).select("series", "year", "month", F.lit(best).alias("model"), M.PRED)
