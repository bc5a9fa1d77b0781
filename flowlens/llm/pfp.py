"""Operator 3: exact substring de-duplication by prefix-free parsing.

Rolling-hash triggers cut every text into phrases: a position is a trigger where the
hash of its GRAM bytes is the smallest of some LENGTH-byte window, so every LENGTH-byte
string holds a trigger that its own content determines (its anchor).  All starts of
such strings with one anchor are consecutive; the bytes they reach are the anchor's
context, a suffix of the phrases before it and a prefix of the parse after it.

* Anchors whose trigger gram occurs once in the corpus are dropped: unique text.
* Anchors with equal contexts need no comparison: every start is repeated.
* The distinct contexts of one trigger are ordered twice, by the bytes after the
  trigger (suffix order of the parse) and by the reversed bytes before it (suffix
  order of the dictionary); longest common prefixes of neighbours give the classes of
  every length.  The string that starts o bytes before the trigger is repeated where
  another context has the same class of o bytes before and LENGTH - o bytes after.

A trigger gram with more contexts than BLOCK is compared block against block, so no
group meets in one task.  Matches never cross documents, repeats are judged on the
input, and all bytes that a repeated string covers are removed.

Nulls: a NULL text is empty.  Texts shorter than LENGTH lose nothing.  Repeated rows
are copies of each other.  A NULL id is kept.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.chunks import make_chunks, open_chunk, runs, window_min
from flowlens.llm.common import _BASE, _BASE_INV, _BYTE_VALUE, _pow_table, materialize, mix64

LENGTH = 400
GRAM = 64
BLOCK = 6000


def anchors(data: np.ndarray, base: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(key, context hash, anchor, first start, last start) of the anchors of a run of texts.

    ``base`` are the text starts with an end mark; positions count from ``data[0]``.
    """
    empty = np.zeros(0, np.int64)
    n = len(data)
    if n < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), empty, empty, empty
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * _pow_table(_BASE, n), out=acc[1:])
    inverse = _pow_table(_BASE_INV, n + 1)
    value = mix64((acc[gram:] - acc[:-gram]) * inverse[:n - gram + 1])
    place = np.uint64((1 << max(24, n.bit_length())) - 1)       # low bits hold the position: leftmost of equals
    mark = (value & ~place) | np.arange(len(value), dtype=np.uint64)
    low = (window_min(mark, length - gram + 1) & place).astype(np.int64)
    room = np.repeat(base[1:], np.diff(base))[:len(low)] - np.arange(len(low))
    start = np.flatnonzero(room >= length)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), empty, empty, empty
    at = low[start]
    new = np.flatnonzero(np.diff(at, prepend=-1) | (np.diff(start, prepend=start[0] - 1) != 1))
    first, last, anchor = start[new], start[np.append(new[1:], len(start)) - 1], at[new]
    end = last + length
    context = (acc[end] - acc[first]) * inverse[first]
    context = mix64(context + ((anchor - first) << 32 | (end - first)).astype(np.uint64))
    return value[anchor], context, anchor, first, last


def list_anchors(chunks: DataFrame) -> DataFrame:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                data, base = open_chunk(r.blob, r.size)
                for s, e in runs(base):
                    key, context, at, first, last = anchors(data[base[s]:base[e]], base[s:e + 1] - base[s])
                    yield pd.DataFrame({"chunk": r.chunk, "key": key.view(np.int64), "context": context.view(np.int64),
                                        "at": at + base[s], "first": first + base[s], "last": last + base[s]})
    return chunks.select("chunk", "size", "blob").mapInPandas(
        find, "chunk long, key long, context long, at long, first long, last long")


def _suffix_order(keys: np.ndarray, texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, longest common prefix with the one before; -1 where the key changes)."""
    order = np.asarray(sorted(range(len(texts)), key=lambda i: (keys[i], texts[i])), np.int64)
    grid = np.frombuffer(b"".join(texts[i].ljust(width, b"\0") for i in order), np.uint8).reshape(-1, width)
    size = np.fromiter((len(texts[i]) for i in order), np.int64, len(order))
    differ = grid[1:] != grid[:-1]
    lcp = np.where(differ.any(1), differ.argmax(1), width)
    lcp = np.minimum(lcp, np.minimum(size[1:], size[:-1]))
    lcp[keys[order[1:]] != keys[order[:-1]]] = -1
    return order, np.concatenate([[-1], lcp])


def shared_offsets(keys: np.ndarray, before: list[bytes], after: list[bytes], low: np.ndarray, high: np.ndarray,
                   length: int = LENGTH, gram: int = GRAM) -> list[list[tuple[int, int]]]:
    """For each context, the runs of offsets o whose string another context of its key holds.

    ``before`` are the bytes ahead of the trigger, reversed; a context has strings for
    the offsets low..high.
    """
    m, top = len(keys), length - gram
    order_a, lcp_a = _suffix_order(keys, after, length)
    order_b, lcp_b = _suffix_order(keys, before, top)
    repeated = np.zeros((m, top + 2), bool)
    step = max(1, 1_500_000 // max(m, 1))
    for o0 in range(0, top + 1, step):
        offset = np.arange(o0, min(o0 + step, top + 1))
        code = np.empty((m, len(offset)), np.int64)
        part = np.empty_like(code)
        code[order_b] = np.cumsum(lcp_b[:, None] < offset[None, :], axis=0)
        part[order_a] = np.cumsum(lcp_a[:, None] < (length - offset)[None, :], axis=0)
        code = code * (m + 1) + part
        inside = (offset[None, :] >= low[:, None]) & (offset[None, :] <= high[:, None])
        code = np.where(inside, code, -1 - np.arange(m)[:, None])
        by = np.argsort(code, axis=0, kind="stable")
        ranked = np.take_along_axis(code, by, 0)
        same = np.zeros((m + 1, len(offset)), bool)
        same[1:-1] = ranked[1:] == ranked[:-1]
        np.put_along_axis(repeated[:, o0:o0 + len(offset)], by, same[1:] | same[:-1], 0)
    out = []
    edge = np.diff(repeated.astype(np.int8), axis=1, prepend=0)
    for i in range(m):
        a, b = np.flatnonzero(edge[i] == 1), np.flatnonzero(edge[i] == -1) - 1
        out.append(list(zip(a.tolist(), b.tolist(), strict=True)))
    return out


def repeated_spans(chunks: DataFrame) -> DataFrame:
    """(chunk, start, stop) byte spans of the chunk data that repeated strings cover."""
    found = materialize(list_anchors(chunks), "anchors")
    # stored first: Spark can split the hot keys of a join of two plain shuffles
    often = materialize(found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "often")
    found = materialize(found.join(often, "key"), "anchors")

    # equal contexts: every start is repeated
    where = F.struct("chunk", "at", "first", "last")
    distinct = materialize(found.groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"), F.min(where).alias("w")), "contexts")
    full = distinct.where("n > 1").select("key", "context")
    whole = found.join(full, ["key", "context"]).select("chunk", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("stop"))

    # several contexts of one trigger: fetch the bytes of one occurrence of each and compare
    several = materialize(distinct.groupBy("key").agg(
        F.count(F.lit(1)).alias("m"), F.sum((F.col("n") == 1).cast("int")).alias("open")).where("m > 1 and open > 0").select(
        "key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "several")
    asked = distinct.join(several, "key").select("key", "context", "n", "blocks", "w.*")

    def fetch(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {c: [] for c in ("key", "context", "n", "blocks", "low", "high", "before", "after")}
        for r in left.itertuples(index=False):
            raw = open_chunk(r.blob, r.size)[0].tobytes()
            for q in right.itertuples(index=False):
                for c, v in (("key", q.key), ("context", q.context), ("n", q.n), ("blocks", q.blocks),
                             ("low", q.at - q.last), ("high", q.at - q.first),
                             ("before", raw[q.first:q.at][::-1]), ("after", raw[q.at:q.last + LENGTH])):
                    out[c].append(v)
        return pd.DataFrame(out)

    contexts = chunks.select("chunk", "size", "blob").groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInPandas(
        fetch, "key long, context long, n long, blocks int, low int, high int, before binary, after binary")
    buckets = max(1, -(-distinct.count() // BLOCK))
    mine = F.pmod(F.xxhash64("context", F.lit(3)), F.col("blocks")).cast("int")
    dealt = (contexts.withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
             .withColumn("bucket", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("key"), F.lit(buckets)))
                         .otherwise(F.xxhash64("key"))))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        spans = shared_offsets(pdf["key"].to_numpy(), pdf["before"].tolist(), pdf["after"].tolist(),
                               pdf["low"].to_numpy(), pdf["high"].to_numpy())
        rows = [(k, c, a, b) for k, c, n, s in zip(pdf["key"], pdf["context"], pdf["n"], spans, strict=True)
                if n == 1 for a, b in s]
        return pd.DataFrame(rows, columns=["key", "context", "near", "far"])

    part = dealt.groupBy("bucket", "i", "j").applyInPandas(compare, "key long, context long, near int, far int")
    some = found.join(part, ["key", "context"]).select(
        "chunk", (F.col("at") - F.col("far")).alias("start"), (F.col("at") - F.col("near") + LENGTH).alias("stop"))
    return whole.union(some)


def merge_spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans, ascending; touching spans become one."""
    if not len(start):
        return start, stop
    by = np.argsort(start, kind="stable")
    start, reach = start[by], np.maximum.accumulate(stop[by])
    new = np.append(True, start[1:] > reach[:-1])
    return start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)]


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def op3(df: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every text."""
    chunks = make_chunks(df)
    spans = repeated_spans(chunks).distinct()

    def cut(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for r in left.itertuples(index=False):
            data, base = open_chunk(r.blob, r.size)
            raw = memoryview(data.tobytes())
            start = right["start"].to_numpy(np.int64)
            stop = right["stop"].to_numpy(np.int64)
            owner = np.searchsorted(base, start, "right") - 1    # spans lie inside one text
            by = np.argsort(owner, kind="stable")
            first = np.searchsorted(owner[by], np.arange(len(base)))
            for i, d in enumerate(r.doc_id):
                own = by[first[i]:first[i + 1]]
                a, b = merge_spans(start[own], stop[own])
                kept, at = hashlib.sha256(), int(base[i])
                for x, y in zip(a.tolist(), b.tolist(), strict=True):
                    kept.update(raw[at:x])
                    at = y
                kept.update(raw[at:int(base[i + 1])])
                rows.append((None if d is None or d != d else int(d), int(base[i + 1] - base[i]), int((b - a).sum()), len(a),
                             kept.hexdigest()))
        out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
        return out.astype({"doc_id": "Int64"})

    return chunks.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInPandas(cut, RESULT)
