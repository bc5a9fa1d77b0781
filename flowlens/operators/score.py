"""Scoring with fitted parameters.

Everything here is a narrow transform (array and arithmetic expressions on
each row) or a single aggregate; models arrive as fitted parameters and are
applied as literal column expressions, so scoring a batch is one stage with
no shuffle and no Python in the row path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.stats import c

# ---- fixed values ----------------------------------------------------------
EXPERT_NAMES = ["eMBB", "mMTC", "URLLC", "TCP_AE", "UDP_AE"]
COMBINER_SLOPE, COMBINER_SHIFT = 4.0, 0.5
DEFAULT_THRESHOLD = 0.5
MINMAX_EPS = 1e-9
OVERFIT_GAP = 0.05
# ---------------------------------------------------------------------------


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


# F10
def apply_calibrator(x: Column, a: float, b: float) -> Column:
    """Platt / MSE-sigmoid calibrator: 1 / (1 + exp(-(a*x + b)))."""
    return sigmoid(F.lit(a) * x + F.lit(b))


# F11
def expert_score_vector(exprs: Sequence[Column | None]) -> Column:
    """Fixed-order score array; a missing expert contributes 0."""
    return F.array(*[(e if e is not None else F.lit(0.0)).cast("double") for e in exprs])


def minmax_calibrated(x: Column, lo: float, hi: float) -> Column:
    """Fallback calibration with stored bounds: (x - lo) / (hi - lo + 1e-9)."""
    return (x - F.lit(lo)) / F.lit(hi - lo + MINMAX_EPS)


# F12
def dot(w: Column, s: Column, k: int | None = None) -> Column:
    """sum_i w_i s_i, folded left from 0.0; with a known length ``k`` the terms are
    plain scalar expressions (whole-stage codegen), else an array fold."""
    if k is None:
        return F.aggregate(F.zip_with(w, s, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    e = F.lit(0.0)
    for i in range(1, k + 1):
        e = e + F.element_at(w, i) * F.element_at(s, i)
    return e


def weighted_combine(weights: Column, scores: Column, k: int | None = len(EXPERT_NAMES)) -> Column:
    """sigma(4 * (sum_i w_i s_i - 0.5))."""
    return sigmoid(F.lit(COMBINER_SLOPE) * (dot(weights, scores, k) - F.lit(COMBINER_SHIFT)))


def softmax_scalars(z: Sequence[Column]) -> Column:
    """Stable softmax of k scalar logits, as an array of scalar expressions."""
    m = F.greatest(*z)
    e = [F.exp(v - m) for v in z]
    total = F.lit(0.0)
    for v in e:
        total = total + v
    return F.array(*[v / total for v in e])


def softmax(z: Column) -> Column:
    """exp(z - max z) / sum over an array column of any length."""
    m = F.array_max(z)
    e = F.transform(z, lambda v: F.exp(v - m))
    total = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(e, lambda v: v / total)


def linear_gate(features: Sequence[Column], W: Sequence[Sequence[float]], b: Sequence[float]) -> Column:
    """Apply a given linear softmax gate: softmax(x W + b); W is d x k."""
    k = len(b)
    logits = []
    for j in range(k):
        z = F.lit(float(b[j]))
        for i, f in enumerate(features):
            z = z + f * F.lit(float(W[i][j]))
        logits.append(z)
    return softmax_scalars(logits)


# F15
def batch_summary(df: DataFrame, pred: str = "pred", prob: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    g = df.groupBy(*[c(b) for b in by]).agg(
        F.sum(c(pred).cast("long")).alias("n_attack_predicted"),
        F.sum((1 - c(pred)).cast("long")).alias("n_benign_predicted"),
        F.avg(c(prob)).alias("mean_probability"), F.avg(c(pred).cast("double")).alias("attack_rate"),
        F.count(F.lit(1)).alias("n_rows"))
    return g


# F16
def dominant_expert(weights: Column) -> Column:
    """0-based index of the largest weight, first on ties."""
    return (F.array_position(weights, F.array_max(weights)) - 1).cast("int")


# F17
def ensemble_or(*flags: Column) -> Column:
    return F.greatest(*flags)


# F21
def ablation_scores(weights: Column, scores: Column, k: int = len(EXPERT_NAMES)) -> dict[str, Column]:
    total = F.lit(0.0)
    for i in range(1, k + 1):
        total = total + F.element_at(scores, i)
    uniform = total / F.lit(float(k))
    hard = F.element_at(scores, dominant_expert(weights) + 1)
    return {"trained": weighted_combine(weights, scores), "uniform": uniform, "hard": hard}
