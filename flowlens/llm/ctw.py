"""Operator 10: language-model scoring by context-tree weighting.

Each byte of a text (A-Z lowered) and an end mark are split into eight binary
decisions.  A decision is predicted by a Krichevsky-Trofimov estimate at every
context depth 0..DEPTH (in bytes); the estimates are mixed along the context path
with the weights that context-tree weighting gives them on the training texts,
P_w = (P_e + prod P_w of the longer contexts) / 2.  The score is the sum of the
logs over all decisions, so a byte's code length is -score / bytes.

How it runs: texts are packed into chunks (a table in the shared folder, so that
later passes see the same chunks).  Every chunk lists its distinct (DEPTH + 1)-grams
and words once, as packed arrays, one row for each part of the keys.  The lists of a
part are added up to corpus counts, with no bound on their number.  The
context tree is built per group of the two nearest context bytes, where the deep
contexts are complete; only the 65,536 decisions of depths 1 and 0 pass through
the driver.  A part then answers each of its lists with the values in the list's
order, and each chunk is sent its own lists and answers.

Nulls: a NULL text is the empty text (only its end mark is scored).  A row without
id is scored but not learned from.  Repeated rows are all counted.  An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import materialize, mix64, release, releasing, run_hashes
from flowlens.llm.langid import id_remainder

DEPTH = 5
END = 0xFF                         # never occurs in UTF-8
GRAM, WORDS = 0, 1
BUCKET_GRAMS = 50_000              # distinct grams of a group, about (one context pair is never split)
PART_BYTES = 8_000_000             # text bytes for each part of the keys
COUNTS = 4096                      # counts whose log Gamma is looked up
ALPHA = 0.1                        # of the unigram base, fixed by the query contract
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


# --- grams and words of packed texts ------------------------------------------

def pack(texts: list) -> tuple[bytes, np.ndarray]:
    """Lower-case (A-Z) UTF-8 texts, each led by DEPTH zero bytes and closed by END; their sizes."""
    lead = b"\0" * DEPTH
    raw = [lead + (t or "").encode("utf-8", "surrogatepass").lower() + bytes([END]) for t in texts]
    return b"".join(raw), np.fromiter(map(len, raw), np.int64, len(raw))


def unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)


def gram_codes(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of each scored byte with its context, codes per text)."""
    n = len(data) - DEPTH
    code = np.zeros(max(n, 0), np.uint64)
    for j in range(DEPTH + 1):
        code = (code << np.uint64(8)) | data[j:j + n]
    stop = np.cumsum(sizes)
    keep = np.ones(len(data), bool)
    for j in range(DEPTH):
        keep[stop - sizes + j] = False
    return code[keep[DEPTH:]], sizes - DEPTH


def word_keys(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words per text)."""
    stop = np.cumsum(sizes)
    inside = ~_SPACE[data]
    for j in range(DEPTH):
        inside[stop - sizes + j] = False
    inside[stop - 1] = False
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return run_hashes(data, a, b), np.diff(np.searchsorted(a, stop), prepend=0)


def text_slices(sizes: np.ndarray, limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` bytes."""
    s = held = 0
    for i, n in enumerate(sizes.tolist()):
        held += n
        if held >= limit:
            yield s, i + 1
            s, held = i + 1, 0
    if s < len(sizes):
        yield s, len(sizes)


def _add(total: tuple[np.ndarray, np.ndarray], keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of two ascending key lists with counts."""
    both = np.concatenate([total[0], keys])
    by = np.argsort(both, kind="stable")                   # two sorted runs
    both = both[by]
    n = np.concatenate([total[1], counts])[by]
    first = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else by
    return both[first], np.add.reduceat(n, first) if len(first) else n


def chunk_counts(data: np.ndarray, sizes: np.ndarray, train: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a chunk, ascending, and their counts in its training texts."""
    base = np.concatenate([[0], np.cumsum(sizes)])
    total = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for s, e in text_slices(sizes):
        keys, per = (gram_codes if kind == GRAM else word_keys)(data[base[s]:base[e]], sizes[s:e])
        learned = np.repeat(train[s:e], per)
        uniq, n = np.unique(keys[learned], return_counts=True)
        total = _add(total, uniq, n)
        uniq = np.unique(keys[~learned])
        total = _add(total, uniq, np.zeros(len(uniq), np.int64))
    return total


# --- the context tree ----------------------------------------------------------

def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x > 0: Stirling's series after eight steps of the recurrence."""
    shift = np.ones_like(x)
    for j in range(8):
        shift = shift * (x + j)
    y = x + 8
    inv = 1 / (y * y)
    series = (1 / 12 - inv * (1 / 360 - inv * (1 / 1260 - inv / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + series - np.log(shift)


_LGAMMA = {x: lgamma(np.arange(COUNTS) + x) for x in (0.5, 1.0)}


def lgamma_count(n: np.ndarray, x: float) -> np.ndarray:
    """log Gamma(n + x) of whole numbers n."""
    out = _LGAMMA[x][np.minimum(n, COUNTS - 1).astype(np.int64)]
    high = n >= COUNTS
    out[high] = lgamma(n[high] + x)
    return out


def kt_log(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return lgamma_count(n0, 0.5) + lgamma_count(n1, 0.5) - lgamma_count(n0 + n1, 1.0) - 1.1447298858494002


def decisions(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, bit) of the eight binary decisions of each key's byte, as (n, 8) arrays."""
    byte = (keys & np.uint64(255)).astype(np.int64)[:, None]
    j = np.arange(8)[None, :]
    return (1 << j) | (byte >> (8 - j)), byte >> (7 - j) & 1


def mix(n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log P_w, weight of the own estimate, probability of a one) of each node."""
    own = kt_log(n0, n1)
    one = (n1 + 0.5) / (n0 + n1 + 1.0)
    if below is None:
        return own, np.ones_like(own), one
    both = np.logaddexp(own, below) - np.log(2.0)
    return both, np.exp(own - np.log(2.0) - both), one


def level_nodes(codes: np.ndarray, counts: np.ndarray):
    """(node of each code and decision, first code, uid, n0, n1 and decision of each node) of one depth.

    ``codes`` are ascending contexts with their byte, so the codes of a node lie together.
    """
    index = np.empty((len(codes), 8), np.int64)
    first, uid, n0, n1 = [], [], [], []
    at = 0
    for j in range(8):
        prefix = codes >> np.uint64(8 - j)                      # the context and the first j bits
        new = np.append(True, prefix[1:] != prefix[:-1])
        index[:, j] = np.cumsum(new) - 1 + at
        start = np.flatnonzero(new)
        ones = np.add.reduceat(np.where(codes >> np.uint64(7 - j) & np.uint64(1), counts, 0.0), start)
        first.append(start)
        uid.append((codes[start] >> np.uint64(8)) << np.uint64(8)
                   | np.uint64(1 << j) | (codes[start] & np.uint64(255)) >> np.uint64(8 - j))
        n0.append(np.add.reduceat(counts, start) - ones)
        n1.append(ones)
        at += len(start)
    decision = np.repeat(np.arange(8), list(map(len, first)))
    return index, *map(np.concatenate, (first, uid, n0, n1)), decision


def deep_tree(keys: np.ndarray, counts: np.ndarray, mixed: bool = True):
    """Levels DEPTH..2 over sorted keys that are complete for their two nearest bytes.

    Returns the depth-2 nodes (uid, n0, n1, log P_w) and, for each key and decision,
    the probability of a one mixed over these levels (None unless ``mixed``).
    """
    node, bit = decisions(keys)
    codes, total = keys, counts.astype(np.float64)
    of_key = np.arange(len(keys))
    p = low = uid = n0 = n1 = log_w = None
    for d in range(DEPTH, 1, -1):
        if low is not None:
            codes, up = np.unique(codes & np.uint64((1 << 8 * (d + 1)) - 1), return_inverse=True)
            total = np.bincount(up, total, len(codes))
            of_key = up[of_key]
        index, first, uid, n0, n1, decision = level_nodes(codes, total)
        below = None
        if low is not None:
            below = np.bincount(index[up[low[0]], low[1]], low[2], len(uid))
        log_w, own, one = mix(n0, n1, below)
        low = first, decision, log_w
        if mixed:
            one = one[index][of_key]
            own = own[index][of_key]
            p = one if p is None else own * one + (1 - own) * p
    return (uid, n0, n1, log_w), None if p is None else p.ravel(), node, bit.ravel().astype(bool)


def shallow_tree(uid: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray):
    """Dense (weight, probability of a one) tables of depths 1 and 0 from depth-1 sums."""
    own1, one1 = np.full(65536, 0.5), np.full(65536, 0.5)
    own0, one0 = np.full(256, 0.5), np.full(256, 0.5)
    if len(uid):
        log_w, own, one = mix(n0, n1, below)
        own1[uid], one1[uid] = own, one
        node = uid & 255
        size = 256
        s0, s1, b0 = (np.bincount(node, x, size) for x in (n0, n1, log_w))
        _, own0, one0 = mix(s0, s1, b0)
    return own1, one1, own0, one0


def key_scores(keys: np.ndarray, counts: np.ndarray, shallow) -> np.ndarray:
    """log10 probability of each key's byte in its context."""
    own1, one1, own0, one0 = shallow
    _, p, node, bit = deep_tree(keys, counts)
    uid1 = (((keys >> np.uint64(8) & np.uint64(255)) << np.uint64(8)).astype(np.int64)[:, None] | node).ravel()
    p = own1[uid1] * one1[uid1] + (1 - own1[uid1]) * p
    flat = node.ravel()
    p = own0[flat] * one0[flat] + (1 - own0[flat]) * p
    return np.log10(np.where(bit, p, 1 - p)).reshape(-1, 8).sum(1)


# --- the Spark jobs --------------------------------------------------------------

CHUNK_SCHEMA = "chunk long, doc_id array<long>, held array<boolean>, learn array<boolean>, size array<long>, blob binary"


def make_chunks(df: DataFrame, chunk_bytes: int = 16_000_000) -> DataFrame:
    """Texts packed into compressed chunks of up to about ``chunk_bytes``, as a stored table.

    The larger a chunk, the fewer grams are listed twice, and the more memory a task takes.
    """
    rest = id_remainder(F.col("doc_id"), 10)
    rows = df.select("doc_id", "text", F.coalesce(rest == 0, F.lit(False)).alias("held"),
                     F.coalesce(rest != 0, F.lit(False)).alias("learn"))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        zip_ = zstandard.ZstdCompressor(level=1)
        part, seq = _task(), 0
        ids, held, learn, texts, room = [], [], [], [], 0

        def chunk():
            data, sizes = pack(texts)
            return pd.DataFrame({"chunk": [part << 32 | seq], "doc_id": [ids], "held": [held], "learn": [learn],
                                 "size": [sizes], "blob": [zip_.compress(data)]})

        for pdf in batches:
            for d, t, h, l in zip(pdf["doc_id"], pdf["text"], pdf["held"], pdf["learn"], strict=True):
                ids.append(None if pd.isna(d) else int(d))
                texts.append(t)
                held.append(bool(h))
                learn.append(bool(l))
                room += 4 * DEPTH + 1 + (len(t) if t else 0)
                if room >= chunk_bytes:
                    yield chunk()
                    ids, held, learn, texts, room, seq = [], [], [], [], 0, seq + 1
        if ids:
            yield chunk()

    return materialize(rows.mapInPandas(releasing(build), CHUNK_SCHEMA), "ctw-chunks")


def _task() -> int:
    from pyspark import TaskContext
    return TaskContext.get().partitionId()


def packed(x: np.ndarray) -> bytes:
    """The array, compressed byte place by byte place."""
    return zstandard.ZstdCompressor(level=1).compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def unpacked(blob: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(unpack(blob).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, np.uint64), dtype=np.uint64)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(keys) % np.uint64(parts)).astype(np.int64)


LIST_SCHEMA = "chunk long, part long, grams binary, gram_counts binary, words binary, word_counts binary"


def list_keys(chunks: DataFrame, parts: int) -> DataFrame:
    """The distinct grams and words of each chunk with their counts in its training texts, a row for each part."""
    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                data, size, learn = unpack(r.blob), np.asarray(r.size, np.int64), np.asarray(r.learn, bool)
                lists = []
                for kind in (GRAM, WORDS):
                    key, n = chunk_counts(data, size, learn, kind)
                    part = part_of(key, parts)
                    by = np.argsort(part, kind="stable")        # the keys of a part stay ascending
                    lists.append((key[by], n[by], np.searchsorted(part[by], np.arange(parts + 1))))
                for s in range(0, parts, 256):
                    rows = [(r.chunk, i, *(x for key, n, cut in lists for x in (packed_keys(key[cut[i]:cut[i + 1]]),
                                                                                packed(n[cut[i]:cut[i + 1]]))))
                            for i in range(s, min(s + 256, parts))]
                    yield pd.DataFrame(rows, columns=[x.split()[0] for x in LIST_SCHEMA.split(", ")])
    return chunks.select("chunk", "learn", "size", "blob").mapInPandas(releasing(keys), LIST_SCHEMA)


def summed(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys of many packed lists and the sums of their counts."""
    empty = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    lists = empty + [(unpacked_keys(k), unpacked(n, np.int64)) for k, n in zip(keys, counts, strict=True)]
    return _add(empty[0], *map(np.concatenate, zip(*lists, strict=True)))


def corpus_counts(lists: DataFrame) -> DataFrame:
    """(key, n, kind): training count of every gram; per part of the words, their number and the sum of their counts."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        key, n = summed(pdf["grams"], pdf["gram_counts"])
        _, total = summed(pdf["words"], pdf["word_counts"])
        release()
        return pd.DataFrame({"key": np.append(key.view(np.int64), (total > 0).sum()), "n": np.append(n, total.sum()),
                             "kind": np.append(np.full(len(key), GRAM), WORDS)})
    return lists.groupBy("part").applyInPandas(add, "key long, n long, kind int")


def tree_values(grams: DataFrame, parts: int) -> DataFrame:
    """(part, key, value): log10 probability of every listed gram, from rows (key, n)."""
    near = F.shiftright("key", 8).bitwiseAND(0xFFFF)
    buckets = max(512, min(1 << 16, grams.count() // BUCKET_GRAMS))
    grouped = grams.withColumn("bucket", F.pmod(F.xxhash64(near), F.lit(buckets)).cast("int"))

    def ordered(pdf):
        pdf = pdf.sort_values("key")
        return pdf["key"].to_numpy().view(np.uint64), pdf["n"].to_numpy()

    def summary(pdf: pd.DataFrame) -> pd.DataFrame:
        (uid, n0, n1, log_w), *_ = deep_tree(*ordered(pdf), mixed=False)
        one = ((uid >> np.uint64(8) & np.uint64(255)) << np.uint64(8) | uid & np.uint64(255)).astype(np.int64)
        return pd.DataFrame({"uid": one, "n0": n0, "n1": n1, "log_w": log_w})

    tops = (grouped.groupBy("bucket").applyInPandas(summary, "uid int, n0 double, n1 double, log_w double")
            .groupBy("uid").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("log_w").alias("log_w"))
            .orderBy("uid").toPandas())                     # at most 65,536 rows: one context byte x 256 nodes
    shallow = shallow_tree(tops["uid"].to_numpy(np.int64), *(tops[c].to_numpy(float) for c in ("n0", "n1", "log_w")))
    shared = grams.sparkSession.sparkContext.broadcast(shallow)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, n = ordered(pdf)
        return pd.DataFrame({"part": part_of(keys, parts), "key": keys.view(np.int64), "value": key_scores(keys, n, shared.value)})

    return grouped.groupBy("bucket").applyInPandas(score, "part long, key long, value float")


def op10(df: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text."""
    chunks = make_chunks(df)
    total = chunks.agg(F.sum(F.size(F.filter("learn", lambda x: x))).alias("ends"),
                       F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda a, b: a + b)).alias("bytes")).first()
    ends, parts = total["ends"] or 0, max(1, -(-(total["bytes"] or 0) // PART_BYTES))
    lists = materialize(list_keys(chunks, parts), "ctw-lists")
    counts = materialize(corpus_counts(lists), "ctw-counts")
    words = counts.where(f"kind = {WORDS}").agg(F.sum("n").alias("n"), F.sum("key").alias("v")).first()
    tokens, distinct = (words["n"] or 0) + ends, (words["v"] or 0) + (ends > 0)
    values = tree_values(counts.where(f"kind = {GRAM}").select("key", "n"), parts)

    def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        by = right["key"].to_numpy().argsort()
        key, value = right["key"].to_numpy()[by].view(np.uint64), right["value"].to_numpy(np.float32)[by]
        word, n = summed(left["words"], left["word_counts"])
        out = pd.DataFrame({"chunk": left["chunk"], "grams": left["grams"],
                            "value": [packed(value[np.searchsorted(key, unpacked_keys(x))]) for x in left["grams"]],
                            "words": left["words"],
                            "total": [packed(n[np.searchsorted(word, unpacked_keys(x))]) for x in left["words"]]})
        release()
        return out

    sent = lists.select("chunk", "part", "grams", "words", "word_counts").groupBy("part").cogroup(
        values.groupBy("part")).applyInPandas(answer, "chunk long, grams binary, value binary, words binary, total binary")

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        gram = joined(right["grams"], right["value"], np.float32)
        word = joined(right["words"], right["total"], np.int64)
        del right
        release()
        out = [score_chunk(r, gram, word, tokens, distinct, ends) for r in left.itertuples(index=False)]
        release()
        return pd.concat(out) if out else pd.DataFrame(columns=[x.split()[0] for x in SCORE_SCHEMA.split(", ")])

    return chunks.groupBy("chunk").cogroup(sent.groupBy("chunk")).applyInPandas(score, SCORE_SCHEMA)


def joined(keys: list, values: list, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The keys of packed lists in one ascending array, and their values."""
    if not len(keys):
        return np.zeros(0, np.uint64), np.zeros(0, kind)
    key = np.concatenate([unpacked_keys(x) for x in keys])
    by = key.argsort()
    return key[by], np.concatenate([unpacked(x, kind) for x in values])[by]


def looked_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The values of keys that are all in the table."""
    if not len(keys):
        return np.zeros(0, table[1].dtype)
    place, distinct = pd.factorize(keys)
    return table[1][np.searchsorted(table[0], distinct)][place]


SCORE_SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")


def score_chunk(r, grams: tuple, words: tuple, tokens: int, distinct: int, ends: int) -> pd.DataFrame:
    """Scores of the texts of one chunk, given the values of its grams and the corpus counts of its words."""
    sizes = np.asarray(r.size, np.int64)
    data, base = unpack(r.blob), np.concatenate([[0], np.cumsum(sizes)])
    n_words, known, unigram, model = (np.zeros(len(sizes)) for _ in range(4))
    below = tokens + ALPHA * (distinct + 1)
    for s, e in text_slices(sizes, 1_000_000):    # several arrays of 8 bytes a byte each
        d = data[base[s]:base[e]]
        code, per = gram_codes(d, sizes[s:e])
        model[s:e] = np.add.reduceat(looked_up(grams, code), np.cumsum(per) - per, dtype=np.float64)
        word, per = word_keys(d, sizes[s:e])
        c = looked_up(words, word).astype(float)
        owner = np.repeat(np.arange(e - s), per)
        n_words[s:e] = per
        known[s:e] = np.bincount(owner, c > 0, e - s)
        unigram[s:e] = np.bincount(owner, np.log10((c + ALPHA) / below), e - s)
    ids = pd.array([None if x is None or x != x else int(x) for x in r.doc_id], "Int64")
    return pd.DataFrame({"doc_id": ids, "held_out": np.asarray(r.held, bool), "n_tokens": n_words.astype(np.int64) + 1,
                         "n_known": known.astype(np.int64) + (ends > 0), "train_tokens": tokens,
                         "base_score": unigram + np.log10((ends + ALPHA) / below), "score": model})
