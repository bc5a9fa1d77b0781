"""Operator 9: nearest neighbours by collision counting over sorted projections.

Every vector is projected on ``lines`` random directions; each block of the table
keeps one sorted array per line.  A query opens a window centred on its own
projection in every array and counts, for each row of the block, the windows it
falls into.  Virtual rehashing widens all windows by a constant factor until
enough rows exceed the collision threshold; those rows are verified with the
exact inner product of the original vectors in double precision.

Largest inner product becomes smallest distance by one extra coordinate,
sqrt(M^2 - |x|^2) with M the largest norm (0 for queries).  Each block finds its own
nearest rows and the blocks' lists are merged per query, so a row is only missed
if its own block misses it; a query that reaches the last radius verifies its
whole block.  Both sides are dealt out by hash in bounded blocks: a stated query
set against all rows.

Nulls: vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do rows without id.  Rows sharing the query's id are its own.  Ties
go to the smaller id.  Only vectors of the query's length are its candidates.
An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LINES = 32
RATIO = 1.35            # widening of the windows from one virtual rehashing to the next
SHARE = 0.55            # collisions asked for, as a share of the lines
ENOUGH = 0.5           # rows of a block that a query verifies before it stops


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<double>, norm2) of the vectors that take part."""
    v = F.col("v")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size("v") > 0) & finite)
            .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
            .where("norm2 > 0"))


def directions(dim: int, lines: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, lines))


def search_block(ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, top2: float, k: int,
                 lines: int = LINES, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, row, score) of the up to ``k`` nearest rows of one block for each query."""
    n, dim = x.shape
    lift = np.sqrt(np.maximum(0.0, top2 - np.einsum("ij,ij->i", x, x)))
    a = directions(dim + 1, lines, seed)
    px = x @ a[:dim] + lift[:, None] * a[dim]
    pq = q @ a[:dim]
    order = np.argsort(px, axis=0, kind="stable")
    lists = np.take_along_axis(px, order, 0)
    rank = np.empty((lines, n), np.uint16)
    for j in range(lines):
        rank[j, order[:, j]] = np.arange(n)
    need, enough = int(np.ceil(SHARE * lines)), min(n, k + 1 + int(ENOUGH * n))
    half = np.full(len(q), 0.5 * np.sqrt(2.0 * top2))
    open_, cand = np.arange(len(q)), np.zeros((len(q), n), bool)
    while len(open_):
        count = np.zeros((len(open_), n), np.uint8 if lines < 256 else np.uint16)
        reach_all = np.ones(len(open_), bool)
        for j in range(lines):
            lo = np.searchsorted(lists[:, j], pq[open_, j] - half[open_], "left")
            hi = np.searchsorted(lists[:, j], pq[open_, j] + half[open_], "right")
            reach_all &= (lo == 0) & (hi == n)
            width = (hi - lo).astype(np.uint16)
            count += (rank[j][None, :] - lo.astype(np.uint16)[:, None]) < width[:, None]
        cand[open_] = count >= need
        done = (cand[open_].sum(1) >= enough) | reach_all
        half[open_] *= RATIO
        open_ = open_[~done]
    score = q @ x.T
    score[~cand | (q_ids[:, None] == ids[None, :])] = -np.inf
    if n > k:                       # every row tied with the k-th stays in until ids decide
        kth = np.partition(score, n - k, axis=1)[:, n - k]
        keep = (score >= kth[:, None]) & np.isfinite(score)
    else:
        keep = np.isfinite(score)
    qi, ri = np.nonzero(keep)
    s = score[qi, ri]
    by = np.lexsort((ids[ri], -s, qi))
    qi, ri, s = qi[by], ri[by], s[by]
    at = np.arange(len(qi)) - np.searchsorted(qi, qi)
    return qi[at < k], ri[at < k], s[at < k]


def nearest(df: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 20,
            block_rows: int = 4096, query_rows: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each row whose id is divisible by ``every``."""
    rows = usable(df, id_col, vec_col)
    stat = rows.agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("top2"),
                    F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    if not stat["q"]:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                           F.col("norm2").alias("score")).where(F.lit(False))
    blocks, chunks = -(-stat["n"] // block_rows), -(-stat["q"] // query_rows)
    top2 = float(stat["top2"])
    data = (rows.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int").alias("block"),
                        "vec_id", "v")
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    ask = (rows.where(F.col("vec_id") % every == 0)
           .select(F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id", F.lit("q")), F.lit(chunks)).cast("int").alias("chunk"),
                   "vec_id", "v")
           .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            right = right.sort_values("vec_id", kind="stable").drop_duplicates("vec_id")
            ids, q_ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            x, q = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
            for s in range(0, len(ids), 60_000):      # ranks are 16-bit; blocks are far smaller as a rule
                qi, ri, sc = search_block(ids[s:s + 60_000], x[s:s + 60_000], q_ids, q, top2, k)
                out["query_id"].append(q_ids[qi])
                out["vec_id"].append(ids[s:s + 60_000][ri])
                out["score"].append(sc)
        return pd.DataFrame({c: np.concatenate(v) if v else [] for c, v in out.items()})

    near = data.groupBy("dim", "block", "chunk").cogroup(ask.groupBy("dim", "block", "chunk")).applyInPandas(
        one, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op9(df: DataFrame) -> DataFrame:
    return nearest(df)
