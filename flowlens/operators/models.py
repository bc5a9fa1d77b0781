"""Detectors, calibration and the gate.

* The random forest is a Spark ML estimator; logistic regressions take Newton steps whose sums
  are one job each; boosted trees are in ``boosting``, dense networks in ``neural``.
* The reconstruction detector is a linear autoencoder: principal axes of
  the benign rows (Spark ML ``PCA``) and the reconstruction error computed
  with array expressions from the fitted axes.
* The isolation forest samples rows per tree by id hash, grows the trees in
  parallel with ``applyInPandas`` (one small group per tree, <= 256 rows),
  and scores rows with a vectorised numpy traversal of the broadcast flat
  trees inside ``mapInPandas`` (Arrow batches, no per-row Python).
* The gate (16-32-16-softmax(5)) is trained by mini-batch Adam inside the
  partitions of one ``mapInPandas`` job per epoch (``neural.fit_epochs``).
Fitted parameters are plain lists, so scoring a batch applies them as
literal column expressions in a single narrow stage.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions.exprs import hash32_array, uniform
from flowlens.functions.stats import agg_row, c, partition_sums
from flowlens.operators import neural as N
from flowlens.operators import score as S

# ---- fixed values (reference hyper-parameters) -------------------------------
RF_PARAMS = {"numTrees": 100, "maxDepth": 20, "minInstancesPerNode": 2}
RF_WORK = {"cacheNodeIds": True, "maxMemoryInMB": 512}       # fewer passes, no descent from the root; the same trees
LR_MAX_ITER, LR_TOLERANCE = 1000, 1e-9
AE_BOTTLENECK = 6
IFOREST_TREES, IFOREST_SAMPLE = 200, 256
GATE_HIDDEN = (32, 16)
GATE_EPOCHS, GATE_LR, GATE_BATCH = 80, 1e-3, 128
GATE_VALIDATION, GATE_PATIENCE, GATE_LR_PATIENCE = 0.1, 10, 5
SEED = 42
# -----------------------------------------------------------------------------


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def positive_probability(df: DataFrame, col: str = "probability", out: str = "p") -> DataFrame:
    return df.withColumn(out, vector_to_array(F.col(col)).getItem(1))


# F1
def train_rf(df: DataFrame, features: Sequence[str], label: str, weight: str | None = None,
             seed: int = SEED, **params) -> PipelineModel:
    p = {**RF_PARAMS, **RF_WORK, **params}
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, seed=seed, **p)
    if weight:
        rf.setWeightCol(weight)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features",
                                            handleInvalid="keep"), rf]).fit(df)


# F3
def newton_logistic(df: DataFrame, inputs: Sequence[Column], label: Column, weight: Column | None = None,
                    l2: float = 0.0, max_iter: int = LR_MAX_ITER) -> tuple[list[float], float]:
    """(coefficients, intercept) of the least sum of weighted log losses + l2 / 2 |coefficients|^2.

    Newton's method: a pass sums loss, gradient and Hessian (d x d numbers travel), so nearly separable
    rows take a few dozen passes where first-order steps take hundreds.  A step that raises the loss is
    halved.  Inputs are centred and scaled while fitting; a constant input has the coefficient 0.
    Missing or non-finite values and labels other than 0 and 1 are errors.
    """
    d, w = len(inputs), F.lit(1.0) if weight is None else weight.cast("double")
    names = [f"_x{i}" for i in range(d)]
    rows = df.select(*[x.cast("double").alias(n) for n, x in zip(names, inputs, strict=True)],
                     label.cast("double").alias("_y"), w.alias("_w"))
    rows = rows.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism).persist()      # every pass is a task a partition
    try:
        finite = functools.reduce(operator.and_, [F.abs(c(n)) < math.inf for n in [*names, "_w"]])
        stats = agg_row(rows, {"bad": F.count_if(~F.coalesce(finite & F.col("_y").isin(0.0, 1.0) & (F.col("_w") >= 0), F.lit(False))),
                               "w": F.sum("_w"), "wy": F.sum(F.col("_w") * F.col("_y"))}
                        | {n: F.avg(c(n)) for n in names} | {f"{n}s": F.stddev_pop(c(n)) for n in names})
        if stats["bad"] or not stats["w"]:
            raise ValueError(f"logistic regression: {stats['bad']} rows with missing or unfit values, weights sum to {stats['w']}")
        if stats["wy"] in (0.0, stats["w"]):                                 # one class
            return [0.0] * d, math.inf if stats["wy"] else -math.inf
        total = stats["w"]
        mean = np.array([stats[n] for n in names])
        sd = np.array([stats[f"{n}s"] for n in names])
        scale = np.where(sd > 0, sd, 1.0)
        ridge = np.append(np.where(sd > 0, l2 / scale ** 2, 1.0) / total, 0.0)

        def sums(at):
            def per_batch(pdf):
                x = np.column_stack([np.where(sd > 0, (pdf[names].to_numpy(float) - mean) / scale, 0.0), np.ones(len(pdf))])
                y, v = pdf["_y"].to_numpy(float), pdf["_w"].to_numpy(float)
                z = x @ at
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
                return np.concatenate([[(v * (np.logaddexp(0.0, z) - y * z)).sum()], x.T @ (v * (p - y)),
                                       (x.T @ (x * (v * p * (1 - p))[:, None])).ravel()])
            out = partition_sums(rows, per_batch, 1 + (d + 1) * (d + 2)) / total
            return out[0] + (ridge * at * at).sum() / 2, out[1:d + 2] + ridge * at, out[d + 2:].reshape(d + 1, d + 1) + np.diag(ridge)

        at, share = np.zeros(d + 1), stats["wy"] / total
        at[d] = math.log(share / (1 - share))
        value, gradient, hessian = sums(at)
        first = value
        for _ in range(max_iter):
            step = np.linalg.lstsq(hessian, gradient, rcond=1e-15)[0]
            gain, part = float(gradient @ step), 1.0
            if not gain > 2 * LR_TOLERANCE * first:
                break
            found = sums(at - step)
            while found[0] > value and part > 1e-6:
                part /= 2
                found = sums(at - part * step)
            if not found[0] < value:
                break
            at, (value, gradient, hessian) = at - part * step, found
    finally:
        rows.unpersist()
    slope = np.where(sd > 0, at[:d] / scale, 0.0)
    return slope.tolist(), float(at[d] - slope @ mean)


class LogisticModel:
    """A fitted logistic regression; ``transform`` adds the vectors ``features`` and ``probability`` and the prediction."""

    def __init__(self, features: Sequence[str], coefficients: Sequence[float], intercept: float):
        self.features, self.coefficients, self.intercept = list(features), list(coefficients), intercept

    def transform(self, df: DataFrame) -> DataFrame:
        z = N.weighted_sum([(w, c(f).cast("double")) for w, f in zip(self.coefficients, self.features, strict=True)], self.intercept)
        t = assemble(df, self.features).withColumn("_p", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
        t = t.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("_p"), F.col("_p"))))
        return t.withColumn("prediction", (F.col("_p") > 0.5).cast("double")).drop("_p")


def train_lr(df: DataFrame, features: Sequence[str], label: str, weight: str,
             max_iter: int = LR_MAX_ITER) -> LogisticModel:
    """Weighted L2 logistic regression on (already scaled) features, sklearn's C=1 on the summed loss."""
    return LogisticModel(features, *newton_logistic(df, [c(f) for f in features], c(label), c(weight), 1.0, max_iter))


# F8 / F9
def fit_sigmoid_calibrator(df: DataFrame, x: str, label: str) -> tuple[float, float]:
    """Platt-style calibrator sigma(a x + b) by logistic regression on one column;
    identity-like (a=1, b=0) when the fitting rows hold a single class."""
    n_cls = df.select(c(label)).distinct().limit(2).count()
    if n_cls < 2:
        return 1.0, 0.0
    (a,), b = newton_logistic(df, [c(x)], c(label))
    return a, b


# F5 (a) linear autoencoder ------------------------------------------------------
def fit_linear_autoencoder(df: DataFrame, features: Sequence[str], k: int = AE_BOTTLENECK) -> dict:
    """Principal axes (k) of the feature rows: mean vector and d x k loading matrix."""
    v = assemble(df, features, "x")
    mean = df.agg(*[F.avg(c(f)) for f in features]).first()
    mu = [float(m or 0.0) for m in mean]
    pca = PCA(k=min(k, len(features)), inputCol="x", outputCol="z").fit(v)
    V = pca.pc.toArray().tolist()
    return {"features": list(features), "mean": mu, "V": V}


def reconstruction_net(ae: dict) -> dict:
    """The linear autoencoder in the form of a network (two linear layers)."""
    return {"features": ae["features"], "layers": N.linear_layers(ae["mean"], ae["V"])}


def reconstruction_mse(df: DataFrame, ae: dict, out: str = "mse") -> DataFrame:
    """mean_j (x_j - xhat_j)^2 with xhat = mu + V V^T (x - mu), as scalar column arithmetic."""
    return N.network_error(df, reconstruction_net(ae), out)


# F6
def row_mse(x: Column, xhat: Column, d: int | None = None) -> Column:
    sq = F.aggregate(F.zip_with(x, xhat, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, t: acc + t)
    return sq / (F.lit(float(d)) if d else F.size(x).cast("double"))


# F7 isolation forest ---------------------------------------------------------------
def _c_factor(n: float) -> float:
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def fit_isolation_forest(df: DataFrame, id_col: str, features: Sequence[str], n_trees: int = IFOREST_TREES,
                         sample: int = IFOREST_SAMPLE, seed: int = SEED) -> dict:
    """Grow ``n_trees`` isolation trees on hash-chosen samples of <= ``sample`` rows.

    Each row joins tree t when its per-tree hash falls under a threshold that
    keeps about 2x ``sample`` candidates per tree; the ``sample`` smallest
    hashes per tree are kept, so every tree sees a deterministic uniform
    sample, independent of partitioning.  Trees grow in parallel, one
    ``applyInPandas`` group each; the flattened trees come back to the driver
    (at most n_trees x (2 * sample - 1) nodes).
    """
    n = df.count()
    psi = min(sample, n)
    thr = min(1.0, 2.0 * sample / max(n, 1)) * 4294967296.0
    feats = list(features)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = df.where(c(id_col).cast("bigint").isNotNull()).select(
        c(id_col).cast("bigint").alias("_i"), c(id_col).alias("_id"), *[c(f).cast("double").alias(f) for f in feats])

    def candidates(batches):
        for pdf in batches:
            once = hash32_array(pdf.pop("_i").to_numpy(np.int64), seed)
            for at in range(0, len(pdf), 4096):
                # second hashing round: independent order per tree
                h = hash32_array(once[at:at + 4096, None] + np.arange(n_trees) * 97531, seed + 1)
                row, tree = np.nonzero(h < thr)
                yield pdf.iloc[at + row].assign(tree=tree.astype(np.int32), _h=h[row, tree])

    doubles = ", ".join(f"`{f}` double" for f in feats)
    cand = rows.mapInPandas(candidates, f"_id {types[id_col]}, {doubles}, tree int, _h bigint")
    height_limit = int(math.ceil(math.log2(max(psi, 2))))
    schema = "tree int, node int, feature int, threshold double, left int, right int, size long"

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(["_h", "_id"]).head(psi)
        X = pdf[feats].to_numpy(dtype=float)
        X = np.nan_to_num(X, nan=0.0, posinf=0.0, neginf=0.0)
        rng = np.random.default_rng(seed * 100003 + t)
        rows = []

        def build(idx, depth):
            node = len(rows)
            rows.append(None)
            sub = X[idx]
            if depth >= height_limit or len(idx) <= 1:
                rows[node] = (t, node, -1, 0.0, -1, -1, len(idx))
                return node
            spans = sub.max(axis=0) - sub.min(axis=0)
            ok = np.flatnonzero(spans > 0)
            if ok.size == 0:
                rows[node] = (t, node, -1, 0.0, -1, -1, len(idx))
                return node
            f = int(rng.choice(ok))
            lo, hi = sub[:, f].min(), sub[:, f].max()
            s = float(rng.uniform(lo, hi))
            left = build(idx[sub[:, f] < s], depth + 1)
            right = build(idx[sub[:, f] >= s], depth + 1)
            rows[node] = (t, node, f, s, left, right, len(idx))
            return node

        build(np.arange(len(X)), 0)
        return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "size"])

    flat = cand.groupBy("tree").applyInPandas(grow, schema).orderBy("tree", "node").collect()
    forest = {}
    for r in flat:
        forest.setdefault(r["tree"], []).append((r["feature"], r["threshold"], r["left"], r["right"], r["size"]))
    return {"features": feats, "psi": psi, "trees": [forest[t] for t in sorted(forest)]}


def isolation_score(df: DataFrame, model: dict, out: str = "if_score") -> DataFrame:
    """Anomaly score 2^(-E[h(x)] / c(psi)) (> 0.5 = anomalous) via mapInPandas over
    the broadcast flat trees (vectorised numpy traversal per batch)."""
    feats = model["features"]
    trees = [np.array(t, dtype=float) for t in model["trees"]]
    for t in trees:                                # the size of a leaf becomes its expected extra depth
        t[:, 4] = [_c_factor(n) for n in t[:, 4]]
    cpsi = _c_factor(model["psi"])
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(trees)
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.DoubleType())])

    def path_len(it):
        ts = bc.value
        for pdf in it:
            X = np.nan_to_num(pdf[feats].to_numpy(dtype=float), nan=0.0, posinf=0.0, neginf=0.0)
            total = np.zeros(len(X))
            for tr in ts:
                node = np.zeros(len(X), dtype=int)
                depth = np.zeros(len(X))
                active = np.ones(len(X), dtype=bool)
                while active.any():
                    f = tr[node, 0].astype(int)
                    leaf = f < 0
                    done = active & leaf
                    if done.any():
                        depth[done] += tr[node[done], 4]
                    active &= ~leaf
                    if not active.any():
                        break
                    ia = np.flatnonzero(active)
                    go_left = X[ia, f[ia]] < tr[node[ia], 1]
                    node[ia] = np.where(go_left, tr[node[ia], 2], tr[node[ia], 3]).astype(int)
                    depth[ia] += 1
                total += depth
            eh = total / len(ts)
            pdf[out] = np.power(2.0, -eh / cpsi) if cpsi > 0 else 0.5
            yield pdf

    return df.mapInPandas(path_len, schema)


# F13 gate --------------------------------------------------------------------------
def _init_gate(d: int, k: int, hidden=GATE_HIDDEN, seed: int = SEED) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    sizes = [d, *hidden, k]
    return [p for a, b in zip(sizes[:-1], sizes[1:]) for p in (N.glorot(rng, a, b), np.zeros(b))]


def _gate_forward(P, X):
    hs = [X]
    h = X
    n_layers = len(P) // 2
    for i in range(n_layers):
        z = h @ P[2 * i] + P[2 * i + 1]
        if i < n_layers - 1:
            h = np.maximum(z, 0.0)
        else:
            z = z - z.max(axis=1, keepdims=True)
            e = np.exp(z)
            h = e / e.sum(axis=1, keepdims=True)
        hs.append(h)
    return hs


def _gate_loss(params, x, scores, y):
    """(layer outputs, combined score, probability, summed cross-entropy) of a batch."""
    hs = _gate_forward(params, x)
    comb = (hs[-1] * scores).sum(axis=1)
    p = 1.0 / (1.0 + np.exp(-4.0 * (comb - 0.5)))
    clipped = np.clip(p, 1e-7, 1 - 1e-7)
    return hs, comb, p, float(-(y * np.log(clipped) + (1 - y) * np.log(1 - clipped)).sum())


def _gate_gradient(params, x, scores, y):
    hs, comb, p, _ = _gate_loss(params, x, scores, y)
    dz = hs[-1] * (scores - comb[:, None]) * (4.0 * (p - y) / len(y))[:, None]
    out = [None] * len(params)
    for i in range(len(params) // 2 - 1, -1, -1):
        out[2 * i], out[2 * i + 1] = hs[i].T @ dz, dz.sum(axis=0)
        if i > 0:
            dz = (dz @ params[2 * i].T) * (hs[i] > 0)
    return out


def train_gate(df: DataFrame, features: Sequence[str], scores: str, label: str, id_col: str | None = None,
               epochs: int = GATE_EPOCHS, lr: float = GATE_LR, batch: int = GATE_BATCH, seed: int = SEED,
               validation: float = GATE_VALIDATION, patience: int = GATE_PATIENCE,
               lr_patience: int = GATE_LR_PATIENCE) -> dict:
    """Train the softmax gate through the fixed combiner sigma(4 (sum w s - 0.5))
    with binary cross-entropy.

    Training is that of ``neural.fit_epochs``.  Validation rows are chosen by a hash of
    ``id_col`` (of the features without it).  ``df`` should be a stored table: each epoch
    reads it once.
    """
    feats = list(features)
    first = df.select(F.size(c(scores)).alias("k")).first()
    k = first["k"] if first else len(S.EXPERT_NAMES)
    data = df.select(*[c(f).cast("double").alias(f"_x{i}") for i, f in enumerate(feats)],
                     *[c(scores).getItem(j).cast("double").alias(f"_s{j}") for j in range(int(k))],
                     c(label).cast("double").alias("_y"),
                     (uniform(c(id_col) if id_col else F.xxhash64(*map(c, feats)), seed + 4_000) < validation).alias("_val")).persist()
    cols, parts = [f"_x{i}" for i in range(len(feats))], [f"_s{j}" for j in range(int(k))]

    def arrays(pdf):
        return np.nan_to_num(pdf[cols].to_numpy(dtype=float)), pdf[parts].to_numpy(dtype=float), pdf["_y"].to_numpy()

    best, best_loss = N.fit_epochs(
        data, arrays, _init_gate(len(feats), int(k), seed=seed), lambda p, x, s, y: _gate_loss(p, x, s, y)[3],
        lambda p, rng, x, s, y: _gate_gradient(p, x, s, y), epochs=epochs, lr=lr, batch=batch, patience=patience,
        lr_patience=lr_patience, seed=seed)
    data.unpersist()
    layers = [(best[2 * i].tolist(), best[2 * i + 1].tolist(), "relu" if i < len(best) // 2 - 1 else "linear")
              for i in range(len(best) // 2)]
    return {"features": feats, "layers": layers, "validation_loss": best_loss}


def gate_weights(df: DataFrame, gate: dict, out: str = "weights") -> DataFrame:
    """The gate's softmax weights as an array column."""
    t, last = N.apply_layers(df, gate["features"], gate["layers"], "_gate")
    return t.select(*[c(x) for x in df.columns], S.softmax_scalars([F.col(x) for x in last]).alias(out))


# Fresh models per fold ------------------------------------------------------------
def cross_validated_scores(df: DataFrame, features: Sequence[str], label: str, fits: dict, fold: str = "fold", keep: Sequence[str] = ()) -> DataFrame:
    """(model, fold, *keep, label, score): every row scored by the models of the folds it is not in.

    ``fits`` maps a model's name to ``fit(training rows) -> transform(rows) -> rows with column
    score``.  ``df`` should be a stored table with a fold column; folds are masks over it.  The
    fits are independent and submitted together.
    """
    from concurrent.futures import ThreadPoolExecutor

    folds = sorted(r[0] for r in df.select(c(fold)).distinct().collect())          # k numbers
    jobs = [(name, k) for name in fits for k in folds]
    with ThreadPoolExecutor(max_workers=4) as pool:
        fitted = dict(zip(jobs, pool.map(lambda j: fits[j[0]](df.where(c(fold) != j[1])), jobs), strict=True))
    out = None
    for (name, k), transform in fitted.items():
        r = transform(df.where(c(fold) == k)).select(F.lit(name).alias("model"), c(fold).alias("fold"), *[c(x) for x in keep], c(label), "score")
        out = r if out is None else out.unionByName(r)
    return out


# F18 / F20 ----------------------------------------------------------------------------
def feature_importance(model: PipelineModel, features: Sequence[str], k: int = 20) -> list[tuple[str, float]]:
    imp = model.stages[-1].featureImportances.toArray()
    pairs = sorted(zip(features, imp), key=lambda t: (-t[1], t[0]))
    return [(f, float(v)) for f, v in pairs[:k]]


def pca_2d(df: DataFrame, vec_col: str, k: int = 2) -> tuple[DataFrame, list[float]]:
    v = df.withColumn("_x", array_to_vector(F.transform(c(vec_col), lambda t: t.cast("double"))))
    m = PCA(k=k, inputCol="_x", outputCol="_pc").fit(v)
    out = m.transform(v).withColumn("pc", vector_to_array("_pc")).drop("_x", "_pc")
    return out, [float(x) for x in m.explainedVariance.toArray()]
