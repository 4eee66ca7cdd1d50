"""Whole grids of models in few passes.

* ``network_grid``: all networks of a grid, for every expanding fold and for the refit on all rows, are trained together.  One Spark job
  per pass gives the gradients of every network still in training; networks of one shape and fold are one batched matrix product.
  A pass costs one job however many combinations there are, so a grid ends after at most ``max_iter`` jobs.  Where one partition holds
  all rows, a pass has nothing to exchange, so a job makes ``STEPS`` passes with the same arithmetic.
* ``ensemble_grid``: a boosted ensemble scores its own shorter prefixes, and a forest its own prefixes and its own trees cut at lower
  depths, so a fit of the longest (and deepest) setting gives the errors of all shorter ones.  Only settings that change the trees
  themselves are fitted.
* ``boosted_grid``: the boosted ensembles left after that are grown together for all settings and folds, with one job per level of their
  trees however many there are, instead of one of Spark's fits each (up to about 1,000 jobs for 150 rounds).  The trees are the same.
  Where one partition holds all rows, the ensembles are also scored where they grow, so the driver gets their errors instead of their trees.

Folds are ranges of a dense ordinal, as in ``ml.grid_search``: no row is copied for a fold.
"""

from __future__ import annotations

import copy
import hashlib
import json
import pickle
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ml as M

ROWS_PER_PARTITION = 1 << 16
STEPS = 50  # passes of a job over a single partition
SCORES = "combo int, params string, fold int, rmse double"


def compact(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions where they would hold only a few rows each: a job over a small table then costs few tasks."""
    return df.coalesce(max(1, -(-n // ROWS_PER_PARTITION)))


def fold_starts(low: int, n: int, n_folds: int) -> list[int]:
    """First test ordinal of each fold (the fold before it is its training range)."""
    size = n // (n_folds + 1)
    return [low + n - (n_folds - f) * size for f in range(n_folds)]


def _result(spark, combos, rows) -> DataFrame:
    return spark.createDataFrame([(ci, json.dumps(combos[ci], sort_keys=True), f, e) for ci, f, e in sorted(rows)], SCORES)


class Store:
    """Results of a search on one input, as tables below a shared folder.  The folder's name holds a fingerprint of the input's rows, so
    results of other rows are never read."""

    def __init__(self, base: DataFrame, root: str, columns):
        self.spark = base.sparkSession
        mark = base.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h"),
                        F.sum(F.xxhash64(*reversed(columns), F.lit(1)).cast("decimal(38,0)")).alias("g")).first()
        self.folder = f"{root.rstrip('/')}/panelkit-tuned/{hashlib.sha1(f'{list(columns)} {mark}'.encode()).hexdigest()}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _path(self, name: str):
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/_SUCCESS")
        return path, path.getFileSystem(sc._jsc.hadoopConfiguration())

    def has(self, name: str) -> bool:
        path, fs = self._path(name)
        return fs.exists(path)

    def rows(self, name: str):
        return self.spark.read.parquet(self.path(name)).collect() if self.has(name) else None

    def put(self, name: str, df: DataFrame) -> None:
        df.coalesce(1).write.mode("overwrite").parquet(self.path(name))


def tuned(base: DataFrame, family: str, features, label: str, store: Store, scratch, params: dict | None = None, n_folds: int = 5):
    """(model, best parameters, scores) of a family's full grid, the best combination refitted on all of ``base``; kept in ``store``."""
    spark, combos = base.sparkSession, M.grid(params or M.GRIDS[family])
    tag = f"{family}-{hashlib.sha1(json.dumps([combos, n_folds], sort_keys=True).encode()).hexdigest()[:16]}"
    if not store.has(f"{tag}-best"):
        if family == "mlp":
            scores, models = network_grid(base, features, label, combos, n_folds)
        else:
            scores = ensemble_grid(base, family, features, label, combos, scratch, n_folds, store=store)
        best = M.best_combo(scores).first()["combo"]
        if family == "mlp":
            store.put(f"{tag}-model", spark.createDataFrame([(models[best].to_json(),)], "model string"))
        else:
            n = base.count()
            M.trainer(family, features, label)(compact(base, n), **combos[best]).write().overwrite().save(store.path(f"{tag}-model"))
        store.put(f"{tag}-scores", scores)
        store.put(f"{tag}-best", spark.createDataFrame([(best,)], "combo int"))
    best = store.rows(f"{tag}-best")[0].combo
    model = (M.NeuralModel.from_json(store.rows(f"{tag}-model")[0].model) if family == "mlp" else M.PipelineModel.load(store.path(f"{tag}-model")))
    return model, combos[best], spark.read.parquet(store.path(f"{tag}-scores"))


# ------------------------------------------------------------------ networks
class _Task:
    """What a pass needs of one network: its shape, training range, scaling and weights."""

    def __init__(self, key, hidden, until: int, cut: int, mean, std):
        self.key, self.hidden, self.until, self.cut, self.mean, self.std = key, tuple(hidden), until, cut, mean, std


def _batched_pass(x, y, o, shapes, weights, group):
    """Gradients (networks x weights) and [train SSE, n, valid SSE, n] of networks of one shape and training range."""
    use = o < group.until
    z = (x[use] - group.mean[:-1]) / group.std[:-1]
    t = (y[use] - group.mean[-1]) / group.std[-1]
    train = o[use] < group.cut
    layers, at = [], 0
    for a, b in shapes:
        layers.append((weights[:, at:at + a * b].reshape(-1, a, b), weights[:, None, at + a * b:at + a * b + b]))
        at += a * b + b
    acts = [np.broadcast_to(z, (len(weights), *z.shape))]
    for i, (w, b) in enumerate(layers):
        v = acts[-1] @ w + b
        acts.append(np.maximum(v, 0) if i < len(layers) - 1 else v)
    err = acts[-1][:, :, 0] - t
    sums = np.stack([(err[:, train] ** 2).sum(axis=1), np.full(len(weights), train.sum()),
                     (err[:, ~train] ** 2).sum(axis=1), np.full(len(weights), (~train).sum())], axis=1)
    delta, parts = np.where(train, err, 0.0)[:, :, None], []
    for i in range(len(layers) - 1, -1, -1):
        parts.append(delta.sum(axis=1))
        parts.append((acts[i].transpose(0, 2, 1) @ delta).reshape(len(weights), -1))
        if i:
            delta = (delta @ layers[i][0].transpose(0, 2, 1)) * (acts[i] > 0)
    return np.concatenate([*parts[::-1], sums], axis=1)


class _Net:
    """One network in training: weights, moments of Adam and the best weights so far."""

    FIELDS = ("w", "m", "v", "best_w")

    def __init__(self, start: np.ndarray, alpha: float, rate: float, patience: int):
        self.w, self.m, self.v, self.best_w = start.copy(), np.zeros_like(start), np.zeros_like(start), start.copy()
        self.best, self.bad, self.active, self.alpha, self.rate, self.patience = np.inf, 0, True, alpha, rate, patience

    def step(self, g: np.ndarray, t: int, b1: float = 0.9, b2: float = 0.999, eps: float = 1e-8) -> None:
        """Pass ``t`` (from 1): gradients and error sums of the current weights; stops after ``patience`` passes without a better error."""
        sse, count, vsse, vcount = g[-4:]
        if vcount > 0:
            score = float(np.sqrt(vsse / vcount))  # error of the current weights
            if score < self.best - 1e-9:
                self.best, self.best_w, self.bad = score, self.w.copy(), 0
            else:
                self.bad += 1
                if self.bad >= self.patience:
                    self.active = False
                    return
        step = g[:-4] / max(count, 1) + self.alpha * self.w
        self.m = b1 * self.m + (1 - b1) * step
        self.v = b2 * self.v + (1 - b2) * step * step
        self.w = self.w - self.rate * (self.m / (1 - b1 ** t)) / (np.sqrt(self.v / (1 - b2 ** t)) + eps)
        if vcount == 0:
            self.best_w = self.w

    def pack(self) -> bytes:
        return np.concatenate([[self.best, self.bad, self.active], *[getattr(self, f) for f in self.FIELDS]]).tobytes()

    def unpack(self, blob: bytes) -> None:
        state = np.frombuffer(blob)
        self.best, self.bad, self.active = float(state[0]), int(state[1]), bool(state[2])
        for f, part in zip(self.FIELDS, np.split(state[3:], len(self.FIELDS)), strict=True):
            setattr(self, f, part)


_SUMS = "net int, slot int, g binary"


def _add(t: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(g) for g in t.column("g").to_pylist()], axis=0)
    return pa.table({"net": t.column("net")[:1], "slot": pa.array([0], pa.int32()), "g": pa.array([total.tobytes()], pa.binary())})


def _sum_by_slot(out: DataFrame) -> DataFrame:
    """One summed vector per network and group of partitions."""
    return out.groupBy("net", "slot").applyInArrow(_add, _SUMS)


def _sum_by_net(out: DataFrame) -> DataFrame:
    """One summed vector per network; the sums are taken in groups of partitions first."""
    return _sum_by_slot(out).groupBy("net").applyInArrow(_add, _SUMS)


def network_grid(base: DataFrame, features, label: str, combos: list[dict], n_folds: int = 5, ordinal: str = "ordinal",
                 max_iter: int = 800, patience: int = 10, seed: int = 42, steps: int = STEPS):
    """Scores of every combination (hidden, alpha, rate) on every fold, and each combination fitted on all of ``base``:
    (scores as SCORES, models by combination).  Same solver as ``ml.fit_mlp``: full-batch Adam, stopped early on the last tenth
    of a training range, whose scaling it takes from that range."""
    spark, features = base.sparkSession, list(features)
    cols = [*features, label]
    low, n = base.agg(F.min(ordinal), F.count(F.lit(1))).first()
    ends = [*fold_starts(low, n, n_folds), low + n]  # the last range is the refit on all rows
    stats = base.agg(*[g(F.when(F.col(ordinal) < e, F.col(c).cast("double"))).alias(f"{k}{f}_{i}")
                       for f, e in enumerate(ends) for i, c in enumerate(cols) for k, g in (("m", F.avg), ("s", F.stddev_pop))]).first()
    scale = [(np.array([stats[f"m{f}_{i}"] for i in range(len(cols))]), np.array([stats[f"s{f}_{i}"] or 1.0 for i in range(len(cols))]))
             for f in range(len(ends))]
    groups, members, nets = [], [], []
    for f, end in enumerate(ends):
        for hidden in dict.fromkeys(tuple(c["hidden"]) for c in combos):
            cut = low + max(-(-9 * (end - low) // 10) - 1, 0)
            groups.append(_Task((f, hidden), hidden, end, cut, *scale[f]))
            members.append([])
            for ci, c in enumerate(combos):
                if tuple(c["hidden"]) == hidden:
                    members[-1].append(len(nets))
                    nets.append((ci, f, len(groups) - 1))
    shapes = [M._mlp_shapes(len(features), g.hidden) for g in groups]
    start = {}
    for g, s in zip(groups, shapes, strict=True):
        rng = np.random.default_rng(seed)
        start[g.key] = np.concatenate([np.concatenate([rng.normal(0, np.sqrt(2.0 / a), a * b), np.zeros(b)]) for a, b in s])
    state = [_Net(start[groups[gi].key], combos[ci]["alpha"], combos[ci]["rate"], patience) for ci, _, gi in nets]

    # a small table has few partitions: the groups are dealt over chunks, so that all cores have work
    parts = max(1, -(-n // ROWS_PER_PARTITION))
    chunks = max(1, min(len(groups), spark.sparkContext.defaultParallelism // parts))
    rows = compact(base.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"), F.col(label).cast("double").alias("y"),
                               F.col(ordinal).cast("long").alias("o")), n)
    if chunks > 1:
        rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).repartitionByRange(chunks, "chunk")
    else:
        rows = rows.withColumn("chunk", F.lit(0))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    out = pa.schema([("net", pa.int32()), ("slot", pa.int32()), ("g", pa.binary())])
    order = np.argsort([-max(s[0][0] * s[0][1] for s in [sh]) * g.until for g, sh in zip(groups, shapes, strict=True)], kind="stable")
    chunk_of = {int(gi): i % chunks for i, gi in enumerate(order)}  # dealt by falling cost

    def passes(live: dict[int, list[int]], t: int, upto: int) -> None:
        """The passes from ``t`` on, before ``upto``, of the networks ``live`` (by group)."""
        held_state = {i: state[i] for ids in live.values() for i in ids}

        def run(batches):
            from pyspark import TaskContext

            held = [b for b in batches if b.num_rows]
            if not held:
                return
            table = pa.Table.from_batches(held)
            chunk = table.column("chunk").to_numpy()
            xs = table.column("x").combine_chunks().flatten().to_numpy().reshape(len(table), -1)
            ys, os_ = table.column("y").to_numpy(), table.column("o").to_numpy()
            slot = TaskContext.get().partitionId() % 64
            for c in np.unique(chunk):
                x, y, o = xs[chunk == c], ys[chunk == c], os_[chunk == c]
                for gi, ids in live.items():
                    if chunk_of[gi] != c:
                        continue
                    if parts == 1:  # all rows are here
                        for at in range(t, upto):
                            on = [i for i in ids if held_state[i].active]
                            if not on:
                                break
                            got = _batched_pass(x, y, o, shapes[gi], np.stack([held_state[i].w for i in on]), groups[gi])
                            for i, g in zip(on, got, strict=True):
                                held_state[i].step(g, at)
                        blobs = [held_state[i].pack() for i in ids]
                    else:
                        got = _batched_pass(x, y, o, shapes[gi], np.stack([held_state[i].w for i in ids]), groups[gi])
                        blobs = [g.tobytes() for g in got]
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([slot] * len(ids), pa.int32()),
                                                      pa.array(blobs, pa.binary())], schema=out)

        got = rows.mapInArrow(run, "net int, slot int, g binary")
        for r in (got if parts == 1 else _sum_by_net(got)).collect():
            if parts == 1:
                state[r.net].unpack(r.g)
            else:
                state[r.net].step(np.frombuffer(r.g), t)

    stride, t = steps if parts == 1 else 1, 1
    try:
        while t <= max_iter:
            live = {gi: on for gi, mem in enumerate(members) if (on := [i for i in mem if state[i].active])}
            if not live:
                break
            upto = min(t + stride, max_iter + 1)
            passes(live, t, upto)
            t = upto
    finally:
        rows.unpersist()

    models, parts_ = {}, []
    for i, (ci, f, gi) in enumerate(nets):
        g = groups[gi]
        scaling = {c: (float(a), float(b)) for c, a, b in zip(cols, g.mean, g.std, strict=True)}
        net = {"weights": state[i].best_w, "shapes": shapes[gi], "features": [f"__z_{c}" for c in features]}
        model = M.NeuralModel(net, scaling, features, label)
        if f == n_folds:
            models[ci] = model
        else:
            parts_.append((ci, f, model))
    return _result(spark, combos, _network_errors(base, parts_, ends, features, label, ordinal)), models


def _network_errors(base, nets, ends, features, label, ordinal) -> list[tuple]:
    """(combination, fold, RMSE on the fold's test range), all in one pass."""
    packed = [(ci, f, ends[f], ends[f + 1], n.net["weights"], n.net["shapes"], np.array([n.scale[c] for c in [*features, label]])) for ci, f, n in nets]
    rows = base.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"), F.col(label).cast("double").alias("y"),
                       F.col(ordinal).cast("long").alias("o")).where(F.col(ordinal) >= ends[0])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("x").flatten().to_numpy().reshape(b.num_rows, -1)
            y, o = b.column("y").to_numpy(), b.column("o").to_numpy()
            found = []
            for ci, f, lo, hi, w, shapes, s in packed:
                use = (o >= lo) & (o < hi)
                if use.any():
                    a = (x[use] - s[:-1, 0]) / s[:-1, 1]
                    layers = M._unpack(w, shapes)
                    for i, (wt, bias) in enumerate(layers):
                        a = a @ wt + bias
                        a = np.maximum(a, 0) if i < len(layers) - 1 else a
                    e = a[:, 0] * s[-1, 1] + s[-1, 0] - y[use]
                    found.append((ci, f, float(e @ e), int(use.sum())))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), (pa.int32(), pa.int32(), pa.float64(), pa.int64()), strict=True)]
                                             if found else [pa.array([], k) for k in (pa.int32(), pa.int32(), pa.float64(), pa.int64())],
                                             names=["combo", "fold", "sse", "n"])

    got = rows.mapInArrow(run, "combo int, fold int, sse double, n long").groupBy("combo", "fold").agg(F.sum("sse").alias("sse"), F.sum("n").alias("n"))
    return [(r.combo, r.fold, float(np.sqrt(r.sse / r.n))) for r in got.collect()]


# ------------------------------------------------------------------ ensembles
def node_arrays(spark, model, path: str) -> dict:
    """The trees of a fitted pipeline's ensemble as arrays (all trees joined; children are places in them), read from the node table
    that Spark ML saves."""
    model.write().overwrite().save(path)
    return _tree_arrays(_node_table(spark, path).orderBy("treeID", "id").toPandas())


def _node_table(spark, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/stages/1_*/data").select("treeID", "nodeData.*").select(
        "treeID", "id", "prediction", "leftChild", "rightChild", "split.featureIndex", F.get("split.leftCategoriesOrThreshold", 0).alias("threshold"))


def _tree_arrays(nodes) -> dict:
    """The arrays of trees numbered from 0, from their nodes in order."""
    tree = nodes["treeID"].to_numpy()
    first = np.searchsorted(tree, np.arange(tree.max() + 1))
    place = {k: i for i, k in enumerate(zip(tree.tolist(), nodes["id"].tolist(), strict=True))}
    child = [[place.get((t, c), i) if c >= 0 else i for i, (t, c) in enumerate(zip(tree.tolist(), nodes[side].tolist(), strict=True))]
             for side in ("leftChild", "rightChild")]
    return {"first": first, "value": nodes["prediction"].to_numpy(float), "left": np.array(child[0]), "right": np.array(child[1]),
            "feature": np.maximum(nodes["featureIndex"].to_numpy(), 0).astype(int), "threshold": nodes["threshold"].fillna(0.0).to_numpy(float)}


def staged_values(trees: dict, x: np.ndarray, depths: list[int | None]) -> list[np.ndarray]:
    """Per wanted depth the values (rows x trees) of the trees cut there (None: not cut)."""
    at = np.tile(trees["first"], (len(x), 1))
    rows, out, level = np.arange(len(x))[:, None], {}, 0
    while True:
        if level in depths:
            out[level] = trees["value"][at]
        go_left = x[rows, trees["feature"][at]] <= trees["threshold"][at]
        nxt = np.where(go_left, trees["left"][at], trees["right"][at])  # a leaf is its own child
        if (nxt == at).all():
            break
        at, level = nxt, level + 1
    whole = trees["value"][at]
    return [out.get(d, whole) for d in depths]


def _staged_sse(trees: dict, x, y, cells, depths, weights) -> np.ndarray:
    """Sums of squared errors by cell (length, depth)."""
    sse = np.zeros(len(cells))
    for i in range(0, len(x), 4096):
        staged = dict(zip(map(str, depths), staged_values(trees, x[i:i + 4096], depths), strict=True))
        for k, (n, d) in enumerate(cells):
            values = staged[str(d)][:, :n]
            e = (values.mean(axis=1) if weights is None else values @ np.array(weights[:n])) - y[i:i + 4096]
            sse[k] += e @ e
    return sse


def staged_errors(test: DataFrame, trees: dict, features, label: str, lengths: list[int], depths: list[int | None], weights=None) -> dict:
    """RMSE by (length, depth): of the first ``length`` trees, cut at ``depth``; the mean of the trees, or their sum under ``weights``."""
    rows = test.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"), F.col(label).cast("double").alias("y"))
    cells = [(n, d) for n in lengths for d in depths]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = b.column("x").flatten().to_numpy().reshape(b.num_rows, -1), b.column("y").to_numpy()
            sse = _staged_sse(trees, x, y, cells, depths, weights)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int32()), pa.array(sse), pa.array([len(x)] * len(cells))],
                                             names=["cell", "sse", "n"])

    got = rows.mapInArrow(run, "cell int, sse double, n long").groupBy("cell").agg(F.sum("sse").alias("sse"), F.sum("n").alias("n")).collect()
    return {cells[r.cell]: float(np.sqrt(r.sse / r.n)) for r in got}


def forest_errors(test: DataFrame, nodes: DataFrame, features, label: str, lengths: list[int], depths: list[int | None]) -> dict:
    """``staged_errors`` of a forest whose trees stay in their node table: every tree meets every block of rows in a task of its own,
    and the values of a block are put together by tree.  The driver gets the errors only."""
    rows = test.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"), F.col(label).cast("double").alias("y"))
    cells, width = [(n, d) for n in lengths for d in depths], len(features)

    def block(batches):
        from pyspark import TaskContext

        held = 0
        for b in batches:
            x, y = _matrix(b.column("x"), b.num_rows), b.column("y").to_numpy(zero_copy_only=False)
            for i in range(0, len(y), 4096):
                yield pa.RecordBatch.from_pydict({"block": [f"{TaskContext.get().partitionId()}-{held}"], "x": [x[i:i + 4096].tobytes()], "y": [y[i:i + 4096].tobytes()]})
                held += 1

    def packed(t: pa.Table) -> pa.Table:
        tree = _tree_arrays(t.to_pandas().sort_values("id").assign(treeID=0))
        return pa.table({"tree": t.column("treeID")[:1].cast(pa.int32()), "arrays": pa.array([pickle.dumps(tree)], pa.binary())})

    def values(batches):
        for b in batches:
            for one in (b.slice(i, 1) for i in range(b.num_rows)):
                r = one.to_pylist()[0]
                staged = staged_values(pickle.loads(r["arrays"]), np.frombuffer(r["x"]).reshape(-1, width), depths)
                yield pa.RecordBatch.from_arrays([one.column("block"), one.column("tree"), one.column("y"), pa.array([np.stack(staged).tobytes()], pa.binary())],
                                                 names=["block", "tree", "y", "v"])

    def errors(t: pa.Table) -> pa.Table:
        t = t.sort_by("tree")
        y = np.frombuffer(t.column("y")[0].as_py())
        v = np.stack([np.frombuffer(z).reshape(len(depths), -1) for z in t.column("v").to_pylist()], axis=2)  # depth, row, tree
        sse = [float(e @ e) for n in lengths for d in range(len(depths)) for e in (v[d, :, :n].mean(axis=1) - y,)]
        return pa.table({"cell": pa.array(range(len(cells)), pa.int32()), "sse": pa.array(sse), "n": pa.array([len(y)] * len(cells))})

    trees = nodes.groupBy("treeID").applyInArrow(packed, "tree int, arrays binary")
    met = rows.mapInArrow(block, "block string, x binary, y binary").crossJoin(trees)
    got = met.mapInArrow(values, "block string, tree int, y binary, v binary").groupBy("block").applyInArrow(errors, "cell int, sse double, n long")
    return {cells[r.cell]: float(np.sqrt(r.sse / r.n)) for r in got.groupBy("cell").agg(F.sum("sse").alias("sse"), F.sum("n").alias("n")).collect()}


# ------------------------------------------------------------------ boosting
BINS = 32  # of a feature, as Spark's learner has them by default
SPLIT_ROWS = 10_000  # rows from which Spark's learner takes its candidate thresholds where there are more
KEEP = 10  # rounds after which the predictions so far are kept with the rows
SLOTS = 64  # groups of partitions that are added up first


def thresholds(values: np.ndarray, expected: float, n_splits: int) -> np.ndarray:
    """Candidate thresholds of one feature, placed as Spark's learner does: between all neighbouring values, or where there are more than
    ``n_splits`` of these, next to the multiples of ``expected`` / (n_splits + 1) rows."""
    v, counts = np.unique(values, return_counts=True)
    if len(v) - 1 <= n_splits:
        return (v[:-1] + v[1:]) / 2.0
    stride, out, seen = expected / (n_splits + 1), [], float(counts[0])
    target = stride
    for i in range(1, len(v)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            out.append((v[i - 1] + v[i]) / 2.0)
            target += stride
    return np.array(out)


class _Tree:
    """A regression tree that grows a level at a time.  ``open``: nodes of the lowest level that may still be split."""

    def __init__(self, max_depth: int, min_leaf: int):
        self.max_depth, self.min_leaf, self.depth = max_depth, min_leaf, 0
        self.feature, self.bin, self.left, self.right, self.value, self.open = [0], [0], [0], [0], [0.0], [0]
        self.impurity = [np.nan]  # of the open nodes, as the split above them left it

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row has reached."""
        feature, cut, left, right = (np.array(v) for v in (self.feature, self.bin, self.left, self.right))
        at, rows = np.zeros(len(bins), int), np.arange(len(bins))
        for _ in range(self.depth):
            at = np.where(bins[rows, feature[at]] <= cut[at], left[at], right[at])  # a leaf is its own child
        return at

    def histogram(self, bins: np.ndarray, target: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(open node, feature, bin) -> rows, sum of the target, sum of its square."""
        where = np.full(len(self.value), -1)
        where[self.open] = np.arange(len(self.open))
        node = where[at]
        use = node >= 0
        k, size = bins.shape[1], len(self.open) * bins.shape[1] * BINS
        cell = ((node[use, None] * k + np.arange(k)) * BINS + bins[use]).ravel()
        t = np.repeat(target[use], k)
        return np.stack([np.bincount(cell, w, size) for w in (None, t, t * t)], axis=1).reshape(len(self.open), k, BINS, 3).astype(float)

    def advance(self, found: np.ndarray) -> None:
        """Splits the open nodes by the rows of ``best_splits``."""
        after, impurity = [], []
        for node, (gain, feature, cut, n, s, ss, ln, ls, lss) in zip(self.open, found.tolist(), strict=True):
            self.value[node] = s / n if n else 0.0
            if not gain > 0:
                continue
            self.feature[node], self.bin[node] = int(feature), int(cut)
            for side, (m, t, tt) in ((self.left, (ln, ls, lss)), (self.right, (n - ln, s - ls, ss - lss))):
                side[node] = child = len(self.value)
                for values, v in ((self.feature, 0), (self.bin, 0), (self.left, child), (self.right, child), (self.value, t / m)):
                    values.append(v)
                spread = (tt - t * t / m) / m
                if self.depth + 1 < self.max_depth and abs(spread) >= np.finfo(float).eps:
                    after.append(child)
                    impurity.append(spread)
        self.open, self.impurity, self.depth = after, impurity, self.depth + 1

    def finished(self) -> "_Tree":
        """The grown tree in compact arrays: a search holds thousands of trees."""
        for name in ("feature", "bin", "left", "right"):
            setattr(self, name, np.array(getattr(self, name), np.int32))
        self.value, self.open, self.impurity = np.array(self.value), [], []
        return self


def best_splits(hist: np.ndarray, n_splits: np.ndarray, min_leaf: int, impurity) -> np.ndarray:
    """Per node of a histogram: gain (not above 0: stays a leaf), feature and bin of the split that lowers the variance most (the first of
    equals), and (rows, sum, sum of squares) of the node and of its left side.  ``impurity``: of the nodes (NaN: of a root, from its sides).
    Small nodes have many splits of equal gain, so the sums are taken in the order of Spark's learner."""
    def variance(a):
        n = np.maximum(a[..., 0], 1.0)
        return (a[..., 2] - a[..., 1] * a[..., 1] / n) / n

    upto = hist.cumsum(axis=2)
    left, whole = upto[:, :, :-1], upto[:, :, -1:]
    right = whole - left
    n = np.maximum(whole[..., 0], 1.0)
    some = int(np.argmax(n_splits > 0))
    own = np.where(np.isnan(impurity), variance(left[:, some, 0] + right[:, some, 0]), impurity)
    gain = own[:, None, None] - left[..., 0] / n * variance(left) - right[..., 0] / n * variance(right)
    least = max(min_leaf, 1)
    ok = (left[..., 0] >= least) & (right[..., 0] >= least) & (np.arange(BINS - 1) < n_splits[:, None])
    flat = np.where(ok, gain, -np.inf).reshape(len(hist), -1)
    first = flat.argmax(axis=1)
    feature, cut = np.divmod(first, BINS - 1)
    rows = np.arange(len(hist))
    return np.column_stack([flat[rows, first], feature, cut, whole[rows, feature, 0], left[rows, feature, cut]])


class _Ensemble:
    """One boosted ensemble in training: its training range and setting, and the trees so far; ``kept`` of them are in the rows' predictions."""

    def __init__(self, fold: int, until: int, n_iter: int = 100, max_depth: int = 3, rate: float = 0.1, min_leaf: int = 1):
        self.fold, self.until, self.n_iter, self.max_depth, self.rate, self.min_leaf = fold, until, n_iter, max_depth, rate, min_leaf
        self.trees, self.kept, self.test, self.errors = [], 0, None, None

    def weights(self) -> list[float]:
        return [self.weight(i) for i in range(len(self.trees))]

    def weight(self, i: int) -> float:
        return self.rate if i else 1.0  # the first tree counts fully, as in Spark's learner

    def predicted(self, bins: np.ndarray, so_far: np.ndarray) -> np.ndarray:
        for i in range(self.kept, len(self.trees)):
            so_far = so_far + np.array(self.trees[i].value)[self.trees[i].places(bins)] * self.weight(i)
        return so_far

    def target(self, y: np.ndarray, so_far: np.ndarray) -> np.ndarray:
        """What the next tree is fitted to: the label, then the negative gradient of the squared error."""
        return 2.0 * (y - so_far) if self.trees else y

    def arrays(self, cuts: list[np.ndarray]) -> dict:
        """The trees in the form of ``node_arrays``."""
        first = np.cumsum([0, *[len(t.value) for t in self.trees[:-1]]])
        out = {"first": first, "value": np.concatenate([t.value for t in self.trees])}
        for side in ("left", "right"):
            out[side] = np.concatenate([getattr(t, side) + np.int32(f) for t, f in zip(self.trees, first, strict=True)])
        out["feature"] = np.concatenate([t.feature for t in self.trees])
        table = np.zeros((len(cuts), BINS))
        for i, c in enumerate(cuts):
            table[i, :len(c)] = c
        out["threshold"] = table[out["feature"], np.concatenate([t.bin for t in self.trees])]
        return out


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)]).astype(np.int64)


def _matrix(column, n: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy().reshape(n, -1)


def boosted_grid(base: DataFrame, features, label: str, settings: list[tuple[dict, int]], ordinal: str = "ordinal", seed: int = 42,
                 steps: int | None = STEPS, tests: list[tuple[int, int, list[int]]] | None = None) -> list:
    """Boosted ensembles of many settings and training ranges, grown together: per (setting, end of the training range) the trees in the form
    of ``node_arrays`` and their weights.  Trees, thresholds and weights are those of Spark's learner.  One job per level gives the histograms of
    all open nodes of all ensembles, added up over the partitions, and their best splits.  Where one partition holds all rows, there is
    nothing to add up, and a job grows ``steps`` trees of every ensemble (None: all).
    ``tests``: per setting (first ordinal, end, lengths) of its test range; then its result is that of ``staged_errors`` on it instead."""
    spark, features = base.sparkSession, list(features)
    ends = sorted({end for _, end in settings})
    rows = base.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"), F.col(label).cast("double").alias("y"),
                       F.col(ordinal).cast("long").alias("o"))
    unknown = F.exists("x", lambda v: v.isNull() | F.isnan(v)) | F.col("y").isNull() | F.isnan("y")
    seen = rows.agg(F.count_if(unknown & (F.col("o") < ends[-1])).alias("bad"), F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("o") < e).alias(f"n{i}") for i, e in enumerate(ends)]).first()
    if seen.bad:
        raise ValueError(f"{seen.bad} rows to fit have a missing feature or label")
    cuts = []
    for i, e in enumerate(ends):
        n = seen[f"n{i}"]
        if not n:
            raise ValueError("a training range has no rows")
        share = min(1.0, max(BINS * BINS, SPLIT_ROWS) / n)
        some = rows.where(F.col("o") < e)
        drawn = (some if share == 1 else some.sample(share, seed)).select("x").toArrow()
        x = _matrix(drawn.column("x"), drawn.num_rows)
        cuts.append([thresholds(x[:, k], len(x), min(BINS, n) - 1) for k in range(len(features))])
    n_splits = [np.array([len(c) for c in cs]) for cs in cuts]
    nets = [_Ensemble(ends.index(end), end, **setting) for setting, end in settings]
    for e, test in zip(nets, tests or [], strict=bool(tests)):
        e.test = test

    parts = max(1, -(-seen.n // ROWS_PER_PARTITION))
    if parts == 1:
        _grow_here(spark, compact(rows, seen.n), nets, cuts, n_splits, steps)
    else:
        _grow_apart(compact(rows.where(F.col("o") < ends[-1]), seen.n), nets, cuts, n_splits, parts)
    if tests:
        o = F.col(ordinal)
        return [e.errors if parts == 1 else staged_errors(base.where((o >= e.test[0]) & (o < e.test[1])), e.arrays(cuts[e.fold]), features, label,
                                                          e.test[2], [None], e.weights()) for e in nets]
    return [(e.arrays(cuts[e.fold]), e.weights()) for e in nets]


def _grow_here(spark, rows, nets, cuts, n_splits, steps: int | None) -> None:
    """All rows in one partition: the ensembles are dealt over chunks by falling cost, each with a copy of the rows.  An ensemble with a
    test range is scored when its last tree is grown, and its trees stay there."""
    chunks = max(1, min(len(nets), spark.sparkContext.defaultParallelism))
    order = np.argsort([-e.until * e.max_depth * e.n_iter for e in nets], kind="stable")
    chunk_of = {int(i): k % chunks for k, i in enumerate(order)}
    rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).repartitionByRange(chunks, "chunk").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        while live := {i: e for i, e in enumerate(nets) if e.errors is None and len(e.trees) < e.n_iter}:
            def run(batches, live=live):
                held = [b for b in batches if b.num_rows]
                if not held:
                    return
                table = pa.Table.from_batches(held)
                chunk, xs = table.column("chunk").to_numpy(), _matrix(table.column("x"), len(table))
                ys, os_ = table.column("y").to_numpy(), table.column("o").to_numpy()
                for i, e in live.items():
                    use = (chunk == chunk_of[i]) & (os_ < e.until)
                    if not use.any():
                        continue
                    bins, y, had = _binned(xs[use], cuts[e.fold]), ys[use], len(e.trees)
                    so_far = e.predicted(bins, np.zeros(len(y)))
                    for _ in range(min(steps or e.n_iter, e.n_iter - had)):
                        tree, target = _Tree(e.max_depth, e.min_leaf), e.target(y, so_far)
                        at = np.zeros(len(y), int)
                        while tree.open:
                            tree.advance(best_splits(tree.histogram(bins, target, at), n_splits[e.fold], e.min_leaf, tree.impurity))
                            at = tree.places(bins)
                        so_far = so_far + np.array(tree.value)[at] * e.weight(len(e.trees))
                        e.trees.append(tree.finished())
                    found = e.trees[had:]
                    if e.test and len(e.trees) == e.n_iter:
                        low, high, lengths = e.test
                        held_out = (chunk == chunk_of[i]) & (os_ >= low) & (os_ < high)
                        cells = [(n, None) for n in lengths]
                        sse = _staged_sse(e.arrays(cuts[e.fold]), xs[held_out], ys[held_out], cells, [None], e.weights())
                        found = {c: float(np.sqrt(v / held_out.sum())) for c, v in zip(cells, sse, strict=True)} if held_out.any() else {}
                        e.trees = []
                    yield pa.RecordBatch.from_pydict({"net": pa.array([i], pa.int32()), "g": pa.array([pickle.dumps(found)], pa.binary())})

            for r in rows.mapInArrow(run, "net int, g binary").collect():
                found = pickle.loads(r.g)
                if isinstance(found, dict):
                    nets[r.net].errors, nets[r.net].trees = found, []
                else:
                    nets[r.net].trees += found
    finally:
        rows.unpersist()


def _grow_apart(rows, nets, cuts, n_splits, parts: int) -> None:
    """Rows over many partitions: a job per level; the predictions of finished trees are kept with the rows every few rounds."""
    schema = "x array<double>, y double, o long, m array<double>"

    def so_far(b):
        x, y, o = _matrix(b.column("x"), b.num_rows), b.column("y").to_numpy(), b.column("o").to_numpy()
        bins = {f: _binned(x, cuts[f]) for f in {e.fold for e in nets}}
        return y, o, bins, _matrix(b.column("m"), b.num_rows)

    def kept(df, nets):
        def run(batches):
            for b in batches:
                if b.num_rows:
                    _, _, bins, m = so_far(b)
                    now = np.column_stack([e.predicted(bins[e.fold], m[:, i]) for i, e in enumerate(nets)])
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, now.size + 1, len(nets)), pa.int32()), pa.array(now.ravel()))
                    yield pa.RecordBatch.from_arrays([b.column("x"), b.column("y"), b.column("o"), lists], names=["x", "y", "o", "m"])

        return df.mapInArrow(run, schema).persist(StorageLevel.MEMORY_AND_DISK)

    def level(df, nets, growing):
        """Best splits of the open nodes of the trees ``growing`` (by ensemble)."""
        def run(batches):
            from pyspark import TaskContext

            total = {}
            for b in batches:
                if not b.num_rows:
                    continue
                y, o, bins, m = so_far(b)
                for i, tree in growing.items():
                    e = nets[i]
                    use = o < e.until
                    mine = bins[e.fold][use]
                    h = tree.histogram(mine, e.target(y[use], e.predicted(mine, m[use, i])), tree.places(mine))
                    total[i] = total[i] + h if i in total else h
            for i, h in total.items():
                yield pa.RecordBatch.from_pydict({"net": pa.array([i], pa.int32()), "slot": pa.array([TaskContext.get().partitionId() % SLOTS], pa.int32()),
                                                  "g": pa.array([h.tobytes()], pa.binary())})

        def best(t: pa.Table) -> pa.Table:
            i = t.column("net")[0].as_py()
            hist = np.sum([np.frombuffer(g) for g in t.column("g").to_pylist()], axis=0).reshape(-1, len(n_splits[0]), BINS, 3)
            found = best_splits(hist, n_splits[nets[i].fold], nets[i].min_leaf, growing[i].impurity)
            return pa.table({"net": t.column("net")[:1], "slot": pa.array([0], pa.int32()), "g": pa.array([found.tobytes()], pa.binary())})

        sums = df.mapInArrow(run, _SUMS)
        got = (_sum_by_slot(sums) if parts > SLOTS else sums).groupBy("net").applyInArrow(best, _SUMS)
        return {r.net: np.frombuffer(r.g).reshape(-1, 9) for r in got.collect()}

    held = rows.withColumn("m", F.array_repeat(F.lit(0.0), len(nets))).persist(StorageLevel.MEMORY_AND_DISK)
    old = []
    try:
        while live := [i for i, e in enumerate(nets) if len(e.trees) < e.n_iter]:
            growing = {i: _Tree(nets[i].max_depth, nets[i].min_leaf) for i in live}
            while now := {i: t for i, t in growing.items() if t.open}:
                for i, found in level(held, nets, now).items():
                    now[i].advance(found)
                while old:
                    old.pop().unpersist()
            for i, tree in growing.items():
                nets[i].trees.append(tree.finished())
            if max(len(e.trees) - e.kept for e in nets) >= KEEP:
                old.append(held)
                held = kept(held, copy.deepcopy(nets))
                for e in nets:
                    e.kept = len(e.trees)
    finally:
        for df in (held, *old):
            df.unpersist()


#: The axes of each family that a fitted ensemble answers itself.
STAGED = {"random_forest": ("num_trees", "max_depth"), "boosted_trees": ("n_iter",)}


def ensemble_grid(base: DataFrame, family: str, features, label: str, combos: list[dict], scratch, n_folds: int = 5,
                  ordinal: str = "ordinal", parallelism: int = 3, store: "Store | None" = None) -> DataFrame:
    """Scores (SCORES) of every combination on every fold.  ``scratch(name)``: a new folder for a node table.  With a ``store`` the
    scores of each fit are kept as soon as it ends, so a search that was stopped goes on where it was.  ``parallelism``: fits at a time;
    Spark's learner holds a forest's uncut trees on the driver."""
    spark, axes = base.sparkSession, STAGED[family]
    length = axes[0]
    low, n = base.agg(F.min(ordinal), F.count(F.lit(1))).first()
    starts = [*fold_starts(low, n, n_folds), low + n]
    fits: dict[str, list[int]] = {}
    for ci, c in enumerate(combos):
        fits.setdefault(json.dumps({k: x for k, x in c.items() if k not in axes}, sort_keys=True), []).append(ci)
    data = compact(base, n).persist(StorageLevel.MEMORY_AND_DISK)
    tasks = [(tuple(cis), f) for f in reversed(range(n_folds)) for cis in fits.values()]  # the longest ranges first

    def kept_as(cis, fold):
        return f"{family}-fit-" + hashlib.sha1(json.dumps([[combos[ci] for ci in cis], fold], sort_keys=True).encode()).hexdigest()[:16]

    def longest(own):
        return {**own[0], **{k: max((c[k] for c in own), key=lambda v: (v is None, v)) for k in axes}}

    def run(task):
        cis, fold = task
        own = [combos[ci] for ci in cis]
        lengths = sorted({c[length] for c in own})
        depths = sorted({c["max_depth"] for c in own}, key=lambda d: (d is None, d)) if "max_depth" in axes else [None]
        at = kept_as(cis, fold)
        known = store.rows(at) if store else None
        if known is not None:
            return [(r.combo, fold, r.rmse) for r in known]
        o = F.col(ordinal)
        if task in grown:
            errors = grown.pop(task)
        else:
            model = M.trainer(family, features, label)(data.where(o < starts[fold]), **longest(own))
            path = scratch(f"{family}-nodes")
            model.write().overwrite().save(path)
            del model  # uncut trees fill the driver
            errors = forest_errors(data.where((o >= starts[fold]) & (o < starts[fold + 1])), _node_table(spark, path), features, label, lengths, depths)
        found = [(ci, fold, errors[c[length], c["max_depth"] if "max_depth" in axes else None]) for ci, c in zip(cis, own, strict=True)]
        if store:
            store.put(at, spark.createDataFrame([(ci, e) for ci, _, e in found], "combo int, rmse double"))
        return found

    grown = {}
    try:
        if family == "boosted_trees":
            left = [t for t in tasks if not (store and store.has(kept_as(*t)))]
            if left:
                settings = [(longest([combos[ci] for ci in cis]), starts[f]) for cis, f in left]
                tests = [(starts[f], starts[f + 1], sorted({combos[ci][length] for ci in cis})) for cis, f in left]
                grown = dict(zip(left, boosted_grid(data, features, label, settings, ordinal, steps=None, tests=tests), strict=True))
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            rows = [r for part in pool.map(run, tasks) for r in part]
    finally:
        data.unpersist()
    return _result(spark, combos, rows)
