"""Operator 2: mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold
them).  Token capacity flows from patterns to source quotas; each pattern offers
one arc per repetition with rising cost, so nothing is repeated while unread
text is left.  Inside a pattern the documents are ordered by a seeded hash and a
prefix of that order takes one more repetition than the rest; what the prefix
leaves open is filled by further prefixes over documents small enough to fit.

Every choice is a comparison with a few cut values per pattern, so reruns agree
and the selection is a narrow map over the documents.  Only the pattern table
and the cut values reach the driver: one row per distinct membership set.

Nulls: a NULL text has size 0; a NULL source is a source of its own, ordered last;
a NULL id hashes like any value.  Repeated rows hash alike and are chosen
together.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.common import WORD, materialize, null_safe_hash

WEIGHTS = (5, 2, 1)   # fixed by the query contract, repeating over the ordered sources
SHARE = 1.5           # of all sizes
CAP = 2               # repetitions of a source and of a document


def source_order(names) -> list:
    return sorted((n for n in names if n is not None)) + [n for n in names if n is None][:1]


def targets(sizes: dict, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> dict:
    """Quota of each source: by weight, stopped at ``cap`` sizes, the excess shared again."""
    order = source_order(list(sizes))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), list(order), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if per * weight[s] > cap * sizes[s]]
        if not over:
            out.update({s: per * weight[s] for s in open_})
            break
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
            open_.remove(s)
    return out


def min_cost_flow(capacity: list[int], members: list[list[int]], quota: list[int],
                  repeats: int = CAP) -> list[dict[int, int]]:
    """Cheapest maximal flow; returns the units each pattern sends to each source.

    Repetition r of a pattern costs r per unit (convex), so successive shortest
    paths (queue-based relaxation) use first readings before second ones.
    """
    n_p, n_s = len(capacity), len(quota)
    start, end = n_p + n_s, n_p + n_s + 1
    to, room, cost, out = [], [], [], [[] for _ in range(n_p + n_s + 2)]

    def arc(u, v, c, w):
        for a, b, r, x in ((u, v, c, w), (v, u, 0, -w)):
            out[a].append(len(to))
            to.append(b)
            room.append(r)
            cost.append(x)

    for p, c in enumerate(capacity):
        for r in range(repeats):
            arc(start, p, c, r)
    sent = {}
    for p, sources in enumerate(members):
        for s in sources:
            sent[p, s] = len(to)
            arc(p, n_p + s, repeats * capacity[p], 0)
    for s, q in enumerate(quota):
        arc(n_p + s, end, q, 0)
    while True:
        dist, via, queue = {start: 0}, {}, deque([start])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if room[e] and (to[e] not in dist or dist[u] + cost[e] < dist[to[e]]):
                    dist[to[e]], via[to[e]] = dist[u] + cost[e], e
                    queue.append(to[e])
        if end not in dist:
            break
        path, v = [], end
        while v != start:
            path.append(via[v])
            v = to[via[v] ^ 1]
        step = min(room[e] for e in path)
        for e in path:
            room[e] -= step
            room[e ^ 1] += step
    flows = [{} for _ in range(n_p)]
    for (p, s), e in sent.items():
        if room[e ^ 1]:
            flows[p][s] = room[e ^ 1]
    return flows


def weighted_cuts(df: DataFrame, need: dict[int, int], levels: int = 5, bits: int = 12) -> dict[int, tuple[int, int]]:
    """Largest cut per pattern: rows (pattern, size, h) with h < cut sum to at most ``need``.

    ``h`` is a 60-bit order key.  Each level sums sizes per key slice of the one
    slice in which the running total crosses the need, so one row per pattern and
    level reaches the driver.  Returns {pattern: (cut, sum below it)}.
    """
    spark = df.sparkSession
    state = {p: (0, 0) for p in need}                    # lower end of the open slice, sum below it
    open_ = {p for p in need if need[p] > 0}
    total_bits = levels * bits
    for level in range(levels):
        if not open_:
            break
        shift = total_bits - bits * (level + 1)
        rows = [(p, state[p][0], state[p][1], int(need[p])) for p in sorted(open_)]
        at = spark.createDataFrame(rows, "_pattern int, lo long, below long, need long")
        part = df.join(F.broadcast(at), "_pattern")       # one row per pattern
        part = part.where((F.col("_h") >= F.col("lo")) & (F.col("_h") < F.col("lo") + F.lit(1 << (shift + bits))))
        sums = part.groupBy("_pattern", "need", "below", F.shiftright("_h", shift).alias("slice")).agg(
            F.sum("_size").alias("size"), (F.min("_h") == F.max("_h")).alias("single"))
        run = F.sum("size").over(Window.partitionBy("_pattern").orderBy("slice")) + F.col("below")
        crossing = (sums.withColumn("run", run).where("run > need").groupBy("_pattern")
                    .agg(F.min("slice").alias("slice"), F.min_by(F.col("run") - F.col("size"), "slice").alias("below"),
                         F.min_by("single", "slice").alias("single")))
        found = {r["_pattern"]: r for r in crossing.collect()}
        for p in list(open_):
            if p in found:
                state[p] = (found[p]["slice"] << shift, found[p]["below"])
                if found[p]["single"]:      # one key in the slice: the cut lies right below it
                    open_.discard(p)
            else:  # everything left fits
                state[p] = (1 << total_bits, state[p][1])
                open_.discard(p)
    return state


@dataclass(frozen=True)
class MixPlan:
    """Repetitions per document, decided by (_members, _size, _h) alone."""

    patterns: DataFrame      # _members, _pattern, _whole, _fit, _cut: one row per membership set
    rounds: int
    sizes: dict
    quota: dict

    def extra(self) -> Column:
        """True where a prefix takes the document once more."""
        return reduce(Column.__or__, [
            (F.col("_size") > 0) & (F.col("_size") <= F.get("_fit", F.lit(i))) & (F.col("_h") < F.get("_cut", F.lit(i)))
            for i in range(self.rounds)], F.lit(False))

    def apply(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_passes``, the times the mix takes each of them."""
        joined = rows.join(F.broadcast(self.patterns), "_members")   # one row per membership set
        return joined.withColumn("_passes", F.col("_whole") + self.extra().cast("int"))


def plan_mix(base: DataFrame, quota_of=targets, fill_rounds: int = 4) -> MixPlan:
    """Plan a mix of the rows (_members array<string>, _size, _h).

    ``quota_of({source: size})`` gives the quota of each source.  After the
    seeded prefix, up to ``fill_rounds - 1`` further prefixes over the documents
    that still fit close the gap that the first document beyond it leaves.
    """
    spark = base.sparkSession
    pats = base.groupBy("_members").agg(F.sum("_size").alias("size")).collect()   # one row per membership set
    pats = sorted(pats, key=lambda r: [(m is None, m or "") for m in r["_members"]])
    names = source_order({m for r in pats for m in r["_members"]})
    sizes = {s: sum(r["size"] for r in pats if s in r["_members"]) for s in names}
    quota = quota_of(sizes) if names else {}
    index = {s: i for i, s in enumerate(names)}
    flows = min_cost_flow([r["size"] for r in pats], [sorted({index[m] for m in r["_members"]}) for r in pats],
                          [round(quota[s]) for s in names])
    flow = [sum(f.values()) for f in flows]
    whole = [f // r["size"] if r["size"] else 0 for f, r in zip(flow, pats, strict=True)]
    left = [f - w * r["size"] for f, w, r in zip(flow, whole, pats, strict=True)]
    fit, cut = [[] for _ in pats], [[] for _ in pats]

    def plan(rounds: int) -> MixPlan:
        lookup = spark.createDataFrame(
            [(r["_members"], p, int(whole[p]), fit[p], cut[p]) for p, r in enumerate(pats)],
            "_members array<string>, _pattern int, _whole int, _fit array<long>, _cut array<long>")
        return MixPlan(lookup, rounds, sizes, quota)

    for k in range(fill_rounds):
        if not any(left):
            return plan(k)
        now = plan(k)
        open_ = now.patterns.select("_members", F.col("_pattern").alias("_p"))
        need = spark.createDataFrame([(p, int(n)) for p, n in enumerate(left)], "_p int, _need long")
        rows = now.apply(base).join(F.broadcast(open_.join(need, "_p").drop("_p")), "_members")
        rows = rows.where((F.col("_passes") == F.col("_whole")) & (F.col("_size") > 0) & (F.col("_size") <= F.col("_need")))
        cuts = weighted_cuts(rows.select("_pattern", "_size", "_h"), dict(enumerate(left)))
        for p, (c, got) in cuts.items():
            fit[p].append(int(left[p]))
            cut[p].append(int(c))
            left[p] -= got
    return plan(fill_rounds)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(seed: int, *cols: Column) -> Column:
    """A seeded 60-bit order key."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), null_safe_hash(*cols)), 4)


def _keyed(df: DataFrame, seed: int) -> list[Column]:
    text = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return [F.array(F.col("source")).alias("_members"), word_count(F.col("text")).alias("_size"),
            order_key(seed, F.col("doc_id"), text).alias("_h")]


def op2(df: DataFrame, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target, taken and passes of every document."""
    base = materialize(df.select("doc_id", *_keyed(df, seed)), "mix-rows")
    plan = plan_mix(base)
    schema = T.StructType([T.StructField("_members", T.ArrayType(T.StringType())),
                           T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())])
    per = df.sparkSession.createDataFrame(
        [([s], int(n), float(plan.quota[s])) for s, n in plan.sizes.items()], schema)
    return (plan.apply(base).join(F.broadcast(per), "_members")      # one row per source
            .select("doc_id", F.col("_size").alias("size"), "source_size", "target",
                    (F.col("_size") * F.col("_passes")).cast("long").alias("taken"),
                    F.col("_passes").alias("passes")))


def mixed_corpus(df: DataFrame, seed: int = 7) -> DataFrame:
    """The mix itself: every document as often as the plan takes it, columns unchanged."""
    # the row travels as one struct, so that its columns clash with nothing
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *_keyed(df, seed))
    plan = plan_mix(materialize(keyed.select("_members", "_size", "_h"), "mix-rows"))
    taken = plan.apply(keyed).where("_passes > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_passes"))).alias("_pass")).select("_row.*")
