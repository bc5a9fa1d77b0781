"""One-pass fit helpers shared by the profiling and cleaning operators.

Every ``fit`` in the library is one aggregate job whose small result (one
row of statistics, or a handful of rows per column) comes back to the
driver and is turned into literal column expressions.  Nothing here moves a
whole column through the driver or through a single task:

* moments, counts, min/max and correlations are ordinary partial/final
  aggregates;
* exact quantiles bracket each target rank with one approximate pass and rank
  only the values inside the brackets (:func:`exact_quantiles`);
* running sums use :func:`cumulative`, a distributed prefix sum (range
  partitioning + per-partition window + a small table of partition offsets),
  so a global ordering never lands in one partition, whatever the input size.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def c(name: str) -> Column:
    """Column reference that tolerates spaces, slashes and dots in names."""
    return F.col(f"`{name}`")


def clean_double(col: Column) -> Column:
    """Double with NaN mapped to NULL (pandas treats NaN as missing)."""
    d = col.cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


@contextmanager
def held(df: DataFrame, *cols: Column):
    """These columns of ``df`` (all without any), cached while several passes read them unless ``df`` is."""
    t = df.select(*cols) if cols else df
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield t
        return
    kept = t.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def agg_row(df: DataFrame, exprs: dict[str, Column]) -> dict:
    """Evaluate many aggregate expressions in ONE job; return them as a dict."""
    if not exprs:
        return {}
    items = list(exprs.items())
    row = df.agg(*[e.alias(f"_a{i}") for i, (_, e) in enumerate(items)]).first()
    return {k: row[f"_a{i}"] for i, (k, _) in enumerate(items)}


def long_format(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (),
                name: str = "column", value: str = "value", cast: str = "double") -> DataFrame:
    """Stack ``cols`` into (ids..., column, value) rows (SQL ``stack``/unpivot)."""
    sel = [c(i) for i in ids] + [c(x).cast(cast).alias(x) for x in cols]
    return df.select(*sel).unpivot(list(ids), list(cols), name, value)


def cumulative(df: DataFrame, order_col, value_cols: Sequence[str],
               key_cols: Sequence[str] = (), descending: bool = False,
               suffix: str = "_cum", parts: int | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` over a global order.

    Distributed prefix sum: rows are range-partitioned on (keys, order); each
    partition computes local running sums with a window partitioned by the
    partition id; the per-partition totals (at most ``parts`` x keys-per-part
    rows) give each partition its offset.  ``order_col`` (a name or a list of
    names) must be unique within a key (group by it first, or add an id).
    ``key_cols`` must have low cardinality (labels, domains, column names):
    the offset table has one row per (partition, key).
    """
    spark = df.sparkSession
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ocols = [order_col] if isinstance(order_col, str) else list(order_col)
    o = [F.col(x).desc() if descending else F.col(x).asc() for x in ocols]
    keys = [F.col(k) for k in key_cols]
    src = df.persist(StorageLevel.MEMORY_AND_DISK)  # read by the range sampler and the shuffle
    # Range bounds come from sampling, so the partition ids are materialised
    # once (reliable checkpoint in the shared checkpoint folder) and both the
    # local sums and the partition totals read the same assignment.
    r = (src.repartitionByRange(parts, *keys, *o).withColumn("_pid", F.spark_partition_id())
         .checkpoint(eager=True))
    src.unpersist()
    w = (Window.partitionBy("_pid", *key_cols).orderBy(*o)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = r.select("*", *[F.sum(v).over(w).alias(f"_l_{v}") for v in value_cols])
    totals = r.groupBy("_pid", *key_cols).agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    wo = Window.partitionBy(*key_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *key_cols, *[
        F.coalesce(F.sum(f"_t_{v}").over(wo), F.lit(0)).alias(f"_o_{v}") for v in value_cols])
    offsets = offsets.select(F.col("_pid").alias("_opid"), *[F.col(k).alias(f"_ok_{k}") for k in key_cols],
                             *[F.col(f"_o_{v}") for v in value_cols])
    cond = F.col("_pid") == F.col("_opid")
    for k in key_cols:  # NULL keys form their own group
        cond = cond & F.col(k).eqNullSafe(F.col(f"_ok_{k}"))
    out = local.join(offsets, cond)
    return out.select(*[F.col(x) for x in df.columns], *[
        (F.col(f"_l_{v}") + F.col(f"_o_{v}")).alias(f"{v}{suffix}") for v in value_cols])


def _bracketed_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                         accuracy: int = 10_000) -> dict:
    """Exact quantiles of an ungrouped frame without shuffling its values.

    One pass of ``percentile_approx`` gives a bracket around every target rank; a second
    pass counts the values below each bracket and collects, on the cluster, the
    distinct values inside it (a few ten-thousandths of the rows), which are ranked.
    A rank outside its bracket gets a ten times wider one and another round.
    """
    with held(df, *[clean_double(c(x)).alias(f"_c{i}") for i, x in enumerate(cols)]) as t:       # three passes a round
        return _ranked_in_brackets(t, cols, probs, accuracy)


def _ranked_in_brackets(t: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int) -> dict:
    open_ = {(i, p): 3.0 / accuracy for i in range(len(cols)) for p in probs}
    n, out = {}, {}
    while open_:
        asked = {}
        for (i, p), d in open_.items():
            asked.setdefault(i, set()).update({max(0.0, p - d), min(1.0, p + d)})
        aggs = [F.count(f"_c{i}").alias(f"_n{i}") for i in asked]
        aggs += [F.percentile_approx(f"_c{i}", sorted(ps), accuracy).alias(f"_q{i}") for i, ps in asked.items()]
        row = t.agg(*aggs).first()
        spans = {}
        for (i, p), d in list(open_.items()):
            n[i] = row[f"_n{i}"]
            if not n[i]:
                out[i, p] = None
                del open_[i, p]
                continue
            at = dict(zip(sorted(asked[i]), row[f"_q{i}"], strict=True))
            spans[i, p] = (-math.inf if p - d <= 0 else at[p - d], math.inf if p + d >= 1 else at[p + d])
        if not open_:
            break
        keys = sorted(spans)
        below = t.agg(*[F.count_if((F.col(f"_c{i}") < F.lit(spans[i, p][0])) & ~F.isnan(f"_c{i}")).alias(f"_b{k}")
                        for k, (i, p) in enumerate(keys)]).first()
        inside = F.array_compact(F.array(*[
            F.when((F.col(f"_c{i}") >= F.lit(spans[i, p][0])) & (F.col(f"_c{i}") <= F.lit(spans[i, p][1])),
                   F.struct(F.lit(k).alias("k"), F.col(f"_c{i}").alias("v"))) for k, (i, p) in enumerate(keys)]))
        ranks = [(k, below[f"_b{k}"], int(math.floor((n[i] - 1) * float(p)))) for k, (i, p) in enumerate(keys)]
        wanted = F.broadcast(t.sparkSession.createDataFrame(ranks, "k int, below long, r long"))  # one row per bracket
        values = t.select(F.explode(inside).alias("x")).groupBy("x.k", "x.v").agg(F.count(F.lit(1)).alias("n"))
        run = F.sum("n").over(Window.partitionBy("k").orderBy("v"))
        hits = (values.select("k", "v", "n", run.alias("upto")).join(wanted, "k")
                .withColumn("last", F.col("below") + F.col("upto") - 1).withColumn("first", F.col("last") - F.col("n") + 1)
                .groupBy("k").agg(F.min(F.when((F.col("first") <= F.col("r")) & (F.col("r") <= F.col("last")), F.col("v"))).alias("lo"),
                                  F.min(F.when((F.col("first") <= F.col("r") + 1) & (F.col("r") + 1 <= F.col("last")), F.col("v"))).alias("hi")))
        found = {r["k"]: (r["lo"], r["hi"]) for r in hits.collect()}
        for k, (i, p) in enumerate(keys):
            pos = (n[i] - 1) * float(p)
            r = int(math.floor(pos))
            lo, hi = found.get(k, (None, None))
            if r == n[i] - 1:
                hi = lo
            if lo is None or hi is None:
                open_[i, p] *= 10
                continue
            out[i, p] = lo if pos == r or lo == hi else lo + (hi - lo) * (pos - r)
            del open_[i, p]
    return {(x,): [out[i, p] for p in probs] for i, x in enumerate(cols)}


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = (), relative_error: float | None = None) -> dict:
    """Linear-interpolation quantiles (pandas / numpy ``linear``), NULL/NaN skipped.

    Returns ``{(*by_values, column): [q(p) for p in probs]}``; a column with no
    values gives ``None`` entries.  Exact by default: distinct (column, value)
    counts are prefix-summed with :func:`cumulative` and only the 2 x len(probs)
    bracketing values per column reach the driver.  ``relative_error`` switches
    to Spark's ``percentile_approx`` (one pass, bounded memory) for callers
    that accept a rank error.
    """
    cols = list(cols)
    by = list(by)
    if not cols:
        return {}
    if relative_error is not None:
        acc = int(max(1, round(1.0 / relative_error)))
        rows = df.groupBy(*[c(b) for b in by]).agg(*[
            F.percentile_approx(clean_double(c(x)), list(probs), acc).alias(f"_q{i}")
            for i, x in enumerate(cols)]).collect()
        out = {}
        for r in rows:
            bv = tuple(r[b] for b in by)
            for i, x in enumerate(cols):
                out[bv + (x,)] = list(r[f"_q{i}"]) if r[f"_q{i}"] is not None else [None] * len(probs)
        return out
    if not by:
        return _bracketed_quantiles(df, cols, probs)
    longdf = long_format(df, cols, ids=by, name="_k", value="_v")
    longdf = longdf.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    counts = longdf.groupBy(*by, "_k", "_v").agg(F.count(F.lit(1)).alias("_n")).persist(
        StorageLevel.MEMORY_AND_DISK)  # read by totals, range sampling and the shuffle
    cum = cumulative(counts, "_v", ["_n"], key_cols=[*by, "_k"])
    totals = {tuple(r[x] for x in [*by, "_k"]): r["_N"]
              for r in counts.groupBy(*by, "_k").agg(F.sum("_n").alias("_N")).collect()}
    # target ranks (0-based) per key
    targets = []
    for key, n in totals.items():
        for p in probs:
            pos = (n - 1) * float(p)
            lo = int(math.floor(pos))
            hi = min(lo + 1, n - 1)
            targets.append(list(key) + [lo])
            targets.append(list(key) + [hi])
    spark = df.sparkSession
    out = {}
    if targets:
        kfields = [T.StructField(b, df.schema[b].dataType) for b in by]
        tschema = T.StructType(kfields + [T.StructField("_k", T.StringType()),
                                          T.StructField("_rank", T.LongType())])
        tdf = spark.createDataFrame(list({tuple(t) for t in targets}), tschema)
        hits = (cum.join(tdf, [*by, "_k"])  # small target table; AQE broadcasts it
                .where((F.col("_rank") >= F.col("_n_cum") - F.col("_n")) & (F.col("_rank") < F.col("_n_cum")))
                .select(*by, "_k", "_rank", "_v").collect())
        val = {tuple(r[x] for x in [*by, "_k", "_rank"]): r["_v"] for r in hits}
        for key, n in totals.items():
            qs = []
            for p in probs:
                pos = (n - 1) * float(p)
                lo = int(math.floor(pos))
                hi = min(lo + 1, n - 1)
                a, b = val[key + (lo,)], val[key + (hi,)]
                qs.append(a + (b - a) * (pos - lo))
            out[key] = qs
    counts.unpersist()
    return out


def quantiles_of(df: DataFrame, cols: Sequence[str], probs: Sequence[float], **kw) -> dict:
    """``{column: [q...]}`` for an ungrouped frame."""
    res = exact_quantiles(df, cols, probs, **kw)
    return {x: res.get((x,), [None] * len(probs)) for x in cols}


def value_counts(df: DataFrame, cols: Sequence[str], name: str = "column",
                 value: str = "value", dropna: bool = True) -> DataFrame:
    """(column, value, count) for several categorical columns in one shuffle."""
    longdf = long_format(df, cols, name=name, value=value, cast="string")
    if dropna:
        longdf = longdf.where(F.col(value).isNotNull())
    return longdf.groupBy(name, value).agg(F.count(F.lit(1)).alias("count"))


def top_value(df: DataFrame, cols: Sequence[str], exclude_value: str | None = None) -> dict:
    """Most frequent value per column, ties to the smallest value (pandas ``mode()[0]``)."""
    vc = value_counts(df, cols)
    if exclude_value is not None:
        vc = vc.where(F.col("value") != F.lit(exclude_value))
    rows = vc.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("top")).collect()
    res = {r["column"]: r["top"] for r in rows}
    return {x: res.get(x) for x in cols}


def partition_sums(df: DataFrame, total, size: int, fan_in: int = 64):
    """Elementwise sum over all rows of ``total(pandas batch) -> float64 array of ``size``.

    Each task sums its batches.  ``fan_in`` tasks sum the partial results, unless ``df`` is cached in
    no more partitions, so at most ``fan_in`` arrays reach the driver.
    """
    import numpy as np
    import pandas as pd

    def per_task(batches):
        from pyspark import TaskContext
        acc = np.zeros(size)
        for pdf in batches:
            if len(pdf):
                acc += total(pdf)
        yield pd.DataFrame({"part": [TaskContext.get().partitionId() % fan_in], "v": [acc.tobytes()]})

    def merge(pdf):
        acc = sum(np.frombuffer(v) for v in pdf["v"])
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "v": [acc.tobytes()]})

    parts = df.mapInPandas(per_task, "part int, v binary")
    if not df.storageLevel.useMemory or df.rdd.getNumPartitions() > fan_in:
        parts = parts.groupBy("part").applyInPandas(merge, "part int, v binary")
    return sum((np.frombuffer(r["v"]) for r in parts.collect()), np.zeros(size))


def pearson(a: Column, b: Column) -> Column:
    """Pairwise-complete Pearson r; NULL (not an error) when a side is constant."""
    both = a.isNotNull() & b.isNotNull()
    x = F.when(both, a)
    y = F.when(both, b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def sample_skew_from_pop(g1: Column, n: Column) -> Column:
    """pandas ``Series.skew`` (adjusted G1) from Spark's population skewness."""
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))
