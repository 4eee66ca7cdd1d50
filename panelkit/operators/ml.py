"""Model training, scoring and ranking on Spark ML.

* fits: OLS (normal equations), random forest, gradient-boosted trees
  (Spark ML estimators - distributed over the rows), and a small dense
  neural regressor trained by data-parallel full-batch gradient descent
  (per-partition gradients in ``mapInPandas``, summed by ``groupBy().sum``,
  driver keeps only the weight vector).
* metrics: one SQL aggregate per (model, split) over a scored table.
* expanding-window grid search: every (combination, fold) fit is an
  independent Spark job over a filtered, cached frame; a small driver-side
  thread pool keeps several jobs in flight.  Scores land in a DataFrame and
  the best combination is picked with ``min_by``.
"""

import functools
import itertools
import json
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRED = "prediction"


def assembler(features) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def ols(features, label: str) -> Pipeline:
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol=PRED, solver="normal",
                          regParam=0.0, elasticNetParam=0.0, fitIntercept=True, standardization=False)
    return Pipeline(stages=[assembler(features), lr])


def random_forest(features, label: str, num_trees: int = 100, max_depth: int | None = 8,
                  min_leaf: int = 1, seed: int = 42, subset: str = "all") -> Pipeline:
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol=PRED, numTrees=num_trees,
                               maxDepth=30 if max_depth is None else max_depth, minInstancesPerNode=min_leaf,
                               featureSubsetStrategy=subset, seed=seed, cacheNodeIds=True)  # deep trees aren't shipped to find a row's node
    return Pipeline(stages=[assembler(features), rf])


def boosted_trees(features, label: str, n_iter: int = 100, max_depth: int = 3, rate: float = 0.1,
                  min_leaf: int = 1, seed: int = 42) -> Pipeline:
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol=PRED, maxIter=n_iter,
                       maxDepth=max_depth, stepSize=rate, minInstancesPerNode=min_leaf, seed=seed, checkpointInterval=10)
    return Pipeline(stages=[assembler(features), gbt])


def one_feature_ols(train: DataFrame, x: str, y: str) -> DataFrame:
    """Slope and intercept of y on x as one aggregate row."""
    return train.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept"))


def gram(df: DataFrame, features, label: str, blocks=None) -> DataFrame:
    """Sufficient statistics of a linear fit, one row per block: n and the sum of every product of two of (1, features, label), as one
    array in row order of the upper triangle.  ``blocks``: column expression numbering the blocks (default: one block).  Sums of blocks
    are the statistics of their union, so one pass serves the whole fit and every expanding fold."""
    cols = [F.lit(1.0), *[F.col(c).cast("double") for c in features], F.col(label).cast("double")]
    known = [F.col(c).isNotNull() for c in [*features, label]]
    pairs = [F.sum(a * b) for i, a in enumerate(cols) for b in cols[i:]]
    rows = df.where(functools.reduce(lambda a, b: a & b, known)).withColumn("block", F.lit(0) if blocks is None else blocks)
    return rows.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.array(*pairs).alias("products"))


def solve_gram(products, size: int) -> tuple[np.ndarray, float]:
    """(coefficients with the intercept first, sum of squared residuals) from the products of ``gram``."""
    g = np.zeros((size, size))
    g[np.triu_indices(size)] = products
    g = g + np.triu(g, 1).T
    d = np.sqrt(np.where(np.diag(g) > 0, np.diag(g), 1.0))  # unit diagonal: columns of any scale
    x = g / d[:, None] / d[None, :]
    beta = np.linalg.lstsq(x[:-1, :-1], x[:-1, -1], rcond=1e-13)[0] * d[-1] / d[:-1]
    return beta, squared_error(products, beta)


def squared_error(products, beta) -> float:
    """Sum of squared residuals of coefficients on the rows that the products come from."""
    size = len(beta) + 1
    g = np.zeros((size, size))
    g[np.triu_indices(size)] = products
    g = g + np.triu(g, 1).T
    w = np.append(beta, -1.0)
    return float(max(w @ g @ w, 0.0))


def ols_folds(base: DataFrame, features, label: str, n_folds: int = 5, ordinal: str = "ordinal") -> DataFrame:
    """(fold, n_train, rmse, coefficients) of OLS on every expanding fold, and on all rows (fold = n_folds, RMSE on them), from one pass over
    the rows: running sums of the blocks' statistics are the training ranges, each next block is the test."""
    features = list(features)
    low, n = base.agg(F.min(ordinal), F.count(F.lit(1))).first()
    size = n // (n_folds + 1)
    first = low + n - n_folds * size
    block = F.when(F.col(ordinal) < first, 0).otherwise(F.floor((F.col(ordinal) - first) / max(size, 1)) + 1).cast("int")
    rows = {r.block: r for r in gram(base, features, label, block).collect()}  # n_folds + 1 rows
    zero = np.zeros((len(features) + 2) * (len(features) + 3) // 2)
    at = lambda b: np.array(rows[b].products) if b in rows else zero
    out, total, seen = [], zero, 0
    for b in range(n_folds + 1):
        total, seen = total + at(b), seen + (rows[b].n if b in rows else 0)
        beta, sse = solve_gram(total, len(features) + 2)
        test, m = (at(b + 1), rows[b + 1].n if b + 1 in rows else 0) if b < n_folds else (total, seen)
        out.append((b, seen, float(np.sqrt(squared_error(test, beta) / m)) if m else None, beta.tolist()))
    return base.sparkSession.createDataFrame(out, "fold int, n_train long, rmse double, coefficients array<double>")


def scored(model_name: str, df: DataFrame, pred, label: str, split: str = "split", keys=()) -> DataFrame:
    """Normalise a scored frame to (model, split, *keys, y, pred)."""
    p = F.col(pred) if isinstance(pred, str) else pred
    return df.select(F.lit(model_name).alias("model"), F.col(split).alias("split"), *keys,
                     F.col(label).cast("double").alias("y"), p.cast("double").alias("pred"))


def metrics(scores: DataFrame) -> DataFrame:
    """Per (model, split): n, RMSE, MAE, R^2 = 1 - SSE / SST.  SST comes from the
    centred variance aggregate; a constant target gives 1 if it is hit exactly, else 0."""
    e = F.col("y") - F.col("pred")
    g = scores.groupBy("model", "split").agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.sum(e * e).alias("__sse"),
        (F.count("y") * F.var_pop("y")).alias("__sst"),
    )
    flat = F.when(F.col("__sse") == 0, 1.0).otherwise(0.0)
    r2 = F.when(F.col("__sst") == 0, flat).otherwise(1 - F.try_divide(F.col("__sse"), F.col("__sst")))
    return g.withColumn("r2", r2).drop("__sse", "__sst")


def metrics_wide(scores: DataFrame) -> DataFrame:
    """One row per model: test and train metrics and the gap
    (test RMSE - train RMSE)."""
    m = metrics(scores)
    te = m.where(F.col("split") == "test").select("model", F.col("rmse").alias("test_rmse"), F.col("mae").alias("test_mae"),
                                                   F.col("r2").alias("test_r2"))
    tr = m.where(F.col("split") == "train").select("model", F.col("rmse").alias("train_rmse"), F.col("r2").alias("train_r2"))
    return te.join(tr, "model", "full").withColumn("gap", F.col("test_rmse") - F.col("train_rmse"))


def rank_models(wide: DataFrame) -> DataFrame:
    return wide.orderBy(F.col("test_rmse").asc_nulls_last(), "model")


def pred_vs_actual(scores: DataFrame, keys, models) -> DataFrame:
    """Holdout table: keys, actual, one prediction column per model."""
    t = scores.where(F.col("split") == "test")
    return t.groupBy(*keys).pivot("model", list(models)).agg(F.first("pred")).join(
        t.groupBy(*keys).agg(F.first("y").alias("actual")), list(keys))


# ---------------------------------------------------------------- grid search
# The searched parameters of each family.  Spark's trees have no counterpart of a minimum node
# size before a split or of a leaf count, so those two axes are absent.
GRIDS = {
    "random_forest": {"num_trees": [50, 100, 200], "max_depth": [3, 5, 8, 12, None], "min_leaf": [1, 2, 4]},
    "boosted_trees": {"n_iter": [50, 100, 150], "max_depth": [3, 5, 7], "rate": [0.03, 0.05, 0.1]},
    "mlp": {"hidden": [(64, 32), (128, 64, 32), (64, 64, 32)], "alpha": [0.001, 0.01, 0.1], "rate": [0.005, 0.01]},
}


def grid(params: dict) -> list[dict]:
    names = list(params)
    return [dict(zip(names, vals)) for vals in itertools.product(*[params[n] for n in names])]


def trainer(family: str, features, label: str):
    """``fit(train, **params) -> model`` for a family of models."""
    if family == "mlp":
        return lambda train, **kw: NeuralModel.fit(train, features, label, **kw)
    make = {"ols": ols, "random_forest": random_forest, "boosted_trees": boosted_trees}[family]
    return lambda train, **kw: make(features, label, **kw).fit(train)


def fitter(family: str, features, label: str):
    """``fit(train, **params) -> (rows -> rows with a prediction)`` for a family of models."""
    fit = trainer(family, features, label)
    return lambda train, **kw: fit(train, **kw).transform


def grid_search(base: DataFrame, fit, combos: list[dict], label: str, n_folds: int = 5, ordinal: str = "ordinal",
                parallelism: int = 4) -> DataFrame:
    """Mean and per-fold RMSE of every combination over expanding folds: (combo, params json, fold, rmse).

    ``base`` has a dense ordinal; a fold is a range of it (fold i tests on the i-th of the last ``n_folds`` blocks of
    n // (n_folds + 1) rows and trains on all rows before), so the rows are kept once and never multiplied."""
    spark = base.sparkSession
    cached = base.persist(StorageLevel.MEMORY_AND_DISK)
    low, n = cached.agg(F.min(ordinal), F.count(F.lit(1))).first()
    size = n // (n_folds + 1)

    def run(task):
        ci, fold = task
        start = low + n - (n_folds - fold) * size
        o = F.col(ordinal)
        predict = fit(cached.where(o < start), **combos[ci])
        e = F.col(label) - F.col(PRED)
        rmse = predict(cached.where((o >= start) & (o < start + size))).agg(F.sqrt(F.avg(e * e)).alias("rmse")).first()["rmse"]
        return (ci, json.dumps(combos[ci], sort_keys=True), fold, None if rmse is None else float(rmse))

    try:
        tasks = [(ci, f) for ci in range(len(combos)) for f in range(n_folds)]
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            rows = list(pool.map(run, tasks))
    finally:
        cached.unpersist()
    return spark.createDataFrame(rows, "combo int, params string, fold int, rmse double")


def mean_scores(scores: DataFrame) -> DataFrame:
    return scores.groupBy("combo", "params").agg(F.avg("rmse").alias("cv_rmse"))


def best_combo(scores: DataFrame) -> DataFrame:
    """The combination of least mean fold RMSE (ties -> lowest id)."""
    return mean_scores(scores).agg(F.min_by(F.struct("combo", "params", "cv_rmse"), F.struct("cv_rmse", "combo")).alias("b")).select("b.*")


def tuned_model(base: DataFrame, family: str, features, label: str, params: dict | None = None, n_folds: int = 5):
    """Search a family's grid (the full one unless ``params`` is given) and refit the best combination on all of
    ``base``.  Returns (model, best parameters, scores)."""
    combos = grid(params or GRIDS[family])
    scores = grid_search(base, fitter(family, features, label), combos, label, n_folds)
    best = combos[best_combo(scores).first()["combo"]]
    return trainer(family, features, label)(base, **best), best, scores


def tune(base: DataFrame, family: str, features, label: str, params: dict | None = None, n_folds: int = 5):
    """``tuned_model`` with the model as a function: (predict, best parameters, scores)."""
    model, best, scores = tuned_model(base, family, features, label, params, n_folds)
    return model.transform, best, scores


# ---------------------------------------------------------------- importances
def impurity_importance(spark, model: PipelineModel, features) -> DataFrame:
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def split_importance(spark, model_path: str, features) -> DataFrame:
    """Number of splits per feature, read from the saved tree model's node
    table (internal nodes have a left child)."""
    nodes = spark.read.parquet(f"{model_path}/stages/1_*/data")
    counts = nodes.where(F.col("nodeData.leftChild") >= 0).groupBy(
        F.col("nodeData.split.featureIndex").alias("idx")).agg(F.count(F.lit(1)).alias("n_splits"))
    names = spark.createDataFrame(list(enumerate(features)), "idx int, feature string")
    return names.join(counts, "idx", "left").select(
        "feature", F.coalesce("n_splits", F.lit(0)).cast("long").alias("n_splits")).orderBy(F.col("n_splits").desc(), "feature")


# ---------------------------------------------------------------- neural regressor
def _mlp_shapes(n_in: int, hidden) -> list[tuple[int, int]]:
    dims = [n_in, *hidden, 1]
    return [(dims[i], dims[i + 1]) for i in range(len(dims) - 1)]


def _unpack(w: np.ndarray, shapes):
    out, k = [], 0
    for a, b in shapes:
        W = w[k:k + a * b].reshape(a, b); k += a * b
        bb = w[k:k + b]; k += b
        out.append((W, bb))
    return out


def _grad_fn(shapes, label):
    """Per partition: gradient of the squared error over training rows
    (role 0) plus [train SSE, train n, valid SSE, valid n] appended."""
    def fn(it, weights):
        layers = _unpack(weights, shapes)
        g = np.zeros(len(weights) + 4)
        for pdf in it:
            if len(pdf) == 0:
                continue
            X = np.stack(pdf["x"].to_numpy())
            y = pdf[label].to_numpy(dtype=float)
            role = pdf["role"].to_numpy()
            acts = [X]
            for i, (W, b) in enumerate(layers):
                z = acts[-1] @ W + b
                acts.append(np.maximum(z, 0) if i < len(layers) - 1 else z)
            err = acts[-1][:, 0] - y
            tr = role == 0
            g[-4] += float(err[tr] @ err[tr]); g[-3] += float(tr.sum())
            g[-2] += float(err[~tr] @ err[~tr]); g[-1] += float((~tr).sum())
            delta = np.where(tr, err, 0.0)[:, None]
            grads = []
            for i in range(len(layers) - 1, -1, -1):
                W, _ = layers[i]
                grads.append((acts[i].T @ delta, delta.sum(0)))
                if i > 0:
                    delta = (delta @ W.T) * (acts[i] > 0)
            g[:-4] += np.concatenate([np.concatenate([gw.ravel(), gb]) for gw, gb in reversed(grads)])
        yield {"g": [g.tolist()]}
    return fn


def fit_mlp(train: DataFrame, features, label: str, hidden=(64, 32), alpha: float = 1e-3, rate: float = 0.01,
            max_iter: int = 800, seed: int = 42, valid: DataFrame | None = None, patience: int = 10):
    """Full-batch Adam on the squared error + L2 (``alpha``).  Inputs should be
    scaled.  Each iteration is one distributed pass (one Spark job): every
    partition emits its gradient and error sums, which are summed element-wise
    on the executors; only the weight vector (a few thousand numbers) lives on
    the driver.  Early stopping watches the RMSE on ``valid`` (e.g. the tail
    of the training period), computed in the same pass."""
    import pandas as pd

    features = list(features)
    shapes = _mlp_shapes(len(features), hidden)
    rng = np.random.default_rng(seed)
    w = np.concatenate([np.concatenate([rng.normal(0, np.sqrt(2.0 / a), a * b), np.zeros(b)]) for a, b in shapes])

    def prep_of(df, role):
        return df.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
                         F.col(label).cast("double").alias(label), F.lit(role).alias("role"))

    data = prep_of(train, 0)
    if valid is not None:
        data = data.unionByName(prep_of(valid, 1))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    out_schema = T.StructType([T.StructField("g", T.ArrayType(T.DoubleType()))])
    m, v = np.zeros_like(w), np.zeros_like(w)
    b1, b2, eps = 0.9, 0.999, 1e-8
    best, best_w, bad = np.inf, w.copy(), 0

    def one_pass(weights):
        f = _grad_fn(shapes, label)
        res = data.mapInPandas(lambda it: (pd.DataFrame(d) for d in f(it, weights)), out_schema)
        rows = res.select(F.posexplode("g").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
        tot = np.zeros(len(weights) + 4)
        for r in rows:
            tot[r["i"]] = r["v"]
        return tot[:-4], tot[-4], tot[-3], tot[-2], tot[-1]

    for t in range(1, max_iter + 1):
        g, sse, n, vsse, vn = one_pass(w)
        if valid is not None and vn > 0:
            score = np.sqrt(vsse / vn)  # error of the current weights
            if score < best - 1e-9:
                best, best_w, bad = score, w.copy(), 0
            else:
                bad += 1
                if bad >= patience:
                    break
        g = g / max(n, 1) + alpha * w
        m = b1 * m + (1 - b1) * g
        v = b2 * v + (1 - b2) * g * g
        w = w - rate * (m / (1 - b1 ** t)) / (np.sqrt(v / (1 - b2 ** t)) + eps)
        if valid is None:
            best_w = w
    data.unpersist()
    return {"weights": best_w, "shapes": shapes, "features": features}


def mlp_predict(model: dict, df: DataFrame, name: str = PRED) -> DataFrame:
    """Score with a fitted network: Arrow-batched pandas UDF over the rows."""
    import pandas as pd

    layers = _unpack(model["weights"], model["shapes"])

    @F.pandas_udf(T.DoubleType())
    def _pred(x: pd.Series) -> pd.Series:
        X = np.stack(x.to_numpy())
        a = X
        for i, (W, b) in enumerate(layers):
            a = a @ W + b
            if i < len(layers) - 1:
                a = np.maximum(a, 0)
        return pd.Series(a[:, 0])

    return df.withColumn(name, _pred(F.array(*[F.col(c).cast("double") for c in model["features"]])))


class NeuralModel:
    """The network with the scaling of its inputs and target, fitted on training rows; their last tenth (by ``ordinal``) stops the training early."""

    def __init__(self, net: dict, scale: dict, features, label: str):
        self.net, self.scale, self.features, self.label = net, scale, list(features), label

    @staticmethod
    def _scaled(df: DataFrame, scale: dict) -> DataFrame:
        return df.withColumns({f"__z_{c}": (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in scale.items()})

    @classmethod
    def fit(cls, train: DataFrame, features, label: str, ordinal: str = "ordinal", patience: int = 10, **kw) -> "NeuralModel":
        cols = [*features, label]
        r = train.agg(*[x for i, c in enumerate(cols) for x in (F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))],
                      F.percentile_approx(ordinal, 0.9).alias("cut")).first()
        scale = {c: (float(r[f"m{i}"]), float(r[f"s{i}"]) or 1.0) for i, c in enumerate(cols)}
        z = cls._scaled(train, scale)
        net = fit_mlp(z.where(F.col(ordinal) < r["cut"]), [f"__z_{c}" for c in features], f"__z_{label}",
                      valid=z.where(F.col(ordinal) >= r["cut"]), patience=patience, **kw)
        return cls(net, scale, features, label)

    def transform(self, df: DataFrame) -> DataFrame:
        m, s = self.scale[self.label]
        out = mlp_predict(self.net, self._scaled(df, {c: self.scale[c] for c in self.features}), "__z")
        return out.withColumn(PRED, F.col("__z") * s + m).drop("__z", *[f"__z_{c}" for c in self.features])

    def to_json(self) -> str:
        net = {"weights": self.net["weights"].tolist(), "shapes": self.net["shapes"], "features": self.net["features"]}
        return json.dumps({"net": net, "scale": self.scale, "features": self.features, "label": self.label})

    @classmethod
    def from_json(cls, text: str) -> "NeuralModel":
        d = json.loads(text)
        net = {"weights": np.array(d["net"]["weights"]), "shapes": [tuple(x) for x in d["net"]["shapes"]], "features": d["net"]["features"]}
        return cls(net, {k: tuple(v) for k, v in d["scale"].items()}, d["features"], d["label"])


# ---------------------------------------------------------------- bundle
def save_bundle(spark, path: str, models: dict, features, board: DataFrame) -> None:
    """Write all models, the feature order, and the leaderboard with the best model first."""
    for name, model in models.items():
        if isinstance(model, NeuralModel):
            spark.createDataFrame([(model.to_json(),)], "model string").write.mode("overwrite").parquet(f"{path}/models/{name}")
        else:
            model.write().overwrite().save(f"{path}/models/{name}")
    spark.createDataFrame(list(enumerate(features)), "position int, feature string").write.mode("overwrite").parquet(f"{path}/features")
    board.write.mode("overwrite").parquet(f"{path}/metrics")


def load_bundle(spark, path: str):
    """(models by name, features in order, leaderboard, name of the best model)"""
    board = spark.read.parquet(f"{path}/metrics")
    features = [r.feature for r in spark.read.parquet(f"{path}/features").orderBy("position").collect()]
    models = {}
    for r in board.select("model").collect():  # one row per model
        where = f"{path}/models/{r.model}"
        models[r.model] = (NeuralModel.from_json(spark.read.parquet(where).first().model) if r.model == "mlp"
                           else PipelineModel.load(where))
    return models, features, board, rank_models(board).first().model
