"""Operator 5: minimax contiguous sharding of atomic groups (native).

Groups of equal texts stay together and are ordered by the SHA-256 of their
text.  The smallest capacity for which the ordered groups fit ``n_shards``
contiguous shards is found by binary search with a greedy check, then the
sequence is cut there.  The driver only holds a summary: byte sums per key
prefix, refined around the possible cut points until every possible cut is a
single group, so the capacity is exact while the number of collected cells
stays bounded whatever the input size.

Nulls: a NULL text has no bytes, size 1 and forms one group with all other NULL texts.
Ties and repeated rows share a group; equal rows get different slots.  An empty
table gives an empty result.  Extra columns are ignored (``shard_table`` takes
the columns it needs by name).
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import materialize, null_safe_hash


def greedy_cuts(ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """Item index after each greedy shard; None when an item does not fit or shards run out.

    ``ends`` are the running totals of the ordered item sizes.
    """
    cuts, base, at = [], 0, 0
    while at < len(ends) and len(cuts) < shards:
        nxt = bisect_right(ends, base + capacity, at)
        if nxt == at:
            return None
        cuts.append(nxt)
        at, base = nxt, ends[nxt - 1]
    return cuts if at == len(ends) else None


def reach(ends: list[int], capacity: int, shards: int) -> list[int]:
    """Like ``greedy_cuts`` for any capacity: stands still where an item does not fit."""
    out, base, at = [], 0, 0
    for _ in range(shards):
        at = bisect_right(ends, base + capacity, at)
        base = ends[at - 1] if at else 0
        out.append(at)
    return out


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Binary search for the smallest capacity whose greedy check succeeds."""
    ends, total = [], 0
    for s in sizes:
        total += s
        ends.append(total)
    lo, hi = max(max(sizes), -(-total // shards)), total
    while lo < hi:
        mid = (lo + hi) // 2
        if greedy_cuts(ends, mid, shards) is None:
            lo = mid + 1
        else:
            hi = mid
    return lo


def even_cuts(sizes: list[int], capacity: int, shards: int) -> list[int]:
    """Cuts under ``capacity`` that lie nearest to an even share of what is left."""
    ends, total = [], 0
    for s in sizes:
        total += s
        ends.append(total)
    back, back_total = [], 0
    for s in reversed(sizes):
        back_total += s
        back.append(back_total)
    earliest = [len(sizes) - x for x in reach(back, capacity, shards)]  # by shards left
    cuts, at, base = [], 0, 0
    for k in range(shards - 1):
        left = shards - 1 - k
        low = max(at, earliest[left - 1])
        high = bisect_right(ends, base + capacity, at)
        ideal = base + (total - base) / (left + 1)
        j = min(max(bisect_right(ends, ideal, at), low), high)
        if j < high and abs(ends[j] - ideal) < abs((ends[j - 1] if j else 0) - ideal):
            j += 1
        cuts.append(j)
        at, base = j, ends[j - 1] if j else 0
    return [*cuts, len(sizes)]


def find_cuts(groups: DataFrame, shards: int, digits: int = 3, step: int = 1) -> tuple[int, list[str]]:
    """(capacity, lowest key of shards 1..) from rows (key, size); keys are hex strings.

    Starts from byte sums of ``16**digits`` key prefixes and refines, ``step``
    digit(s) at a time, the prefixes that any cut of the optimum may fall into.
    """

    def cells(df: DataFrame, width: int) -> list[tuple[str, int, bool]]:
        rows = (df.groupBy(F.substring("key", 1, width).alias("cell"))
                .agg(F.sum("size").alias("size"), (F.min("key") == F.max("key")).alias("whole")).collect())
        return sorted((r["cell"], r["size"], r["whole"]) for r in rows)

    items = cells(groups, digits)
    if not items:
        return 0, []
    while True:
        sizes = [s for _, s, _ in items]
        capacity = smallest_capacity(sizes, shards)
        unit = max((s for _, s, whole in items if not whole), default=0)
        ends, total = [], 0
        for s in sizes:
            total += s
            ends.append(total)
        low, high = reach(ends, capacity - unit, shards), reach(ends, capacity + unit, shards)
        near = {i for a, b in zip(low, high, strict=True) for i in range(max(0, a - 1), min(b + 1, len(items)))}
        open_cells = [items[i] for i in sorted(near) if not items[i][2]]
        if not open_cells:
            cuts = even_cuts(sizes, capacity, shards)
            bounds = [items[c][0] if c < len(items) else "~" for c in cuts[:-1]]
            return capacity, bounds
        width = min(len(c) for c, _, _ in open_cells)
        todo = {c for c, _, _ in open_cells if len(c) == width}
        part = groups.where(F.substring("key", 1, width).isin(sorted(todo)))
        items = sorted([x for x in items if x[0] not in todo] + cells(part, width + step))


def shard_table(df: DataFrame, shards: int = 16, text: str = "text", id_col: str = "doc_id",
                rows_per_slot_group: int = 100_000) -> DataFrame:
    """doc_id, size, text_crc32, group key, shard and slot of every row of ``df``."""
    t = F.col(text)
    base = materialize(df.select(
        F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(t, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.sha2(t, 256), F.lit("0" * 64)).alias("key")), "shard-rows")
    _, bounds = find_cuts(base.groupBy("key").agg(F.sum("size").alias("size")), shards)
    shard = F.lit(0)
    for b in bounds:  # at most shards - 1 literals; the row count of the input plays no part
        shard = shard + (F.col("key") >= F.lit(b)).cast("int")
    # Slots: rank inside a hash sub-group plus the rows of the sub-groups before it.
    subs = max(1, -(-base.count() // (shards * rows_per_slot_group)))
    placed = base.select("*", shard.alias("shard"),
                         F.pmod(null_safe_hash(F.col("doc_id")), F.lit(subs)).cast("int").alias("sub"))
    counts = placed.groupBy("shard", "sub").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select("shard", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = Window.partitionBy("shard", "sub").orderBy("doc_id", "key")
    return (placed.withColumn("rank", F.row_number().over(rank)).join(start, ["shard", "sub"])
            .select("doc_id", "size", "text_crc32", "key", "shard",
                    (F.col("start") + F.col("rank") - 1).alias("slot")))


def op5(df: DataFrame, shards: int = 16) -> DataFrame:
    return shard_table(df, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
