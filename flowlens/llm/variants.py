"""Operator 13: spelling variants by search schemes over FM-indexes of the vocabulary.

Two words are near if one inserted, deleted or replaced code point turns one into the
other.  One error leaves one half of the query untouched, so two searches find every
near word: match the left half from the word's opening delimiter and extend to the
right with one error up to the closing delimiter, or match the right half from the
closing delimiter and extend to the left.  Each search keeps suffix-rank intervals of
an index over the delimited vocabulary; the two directions of a bidirectional index
are the index of the words (extended to the right) and that of the mirrored words.
Both halves start at a delimiter, so no interval has to pass from one direction to
the other.

The distinct words are cut by range into shards of ``shard_words`` words, once by the
word and once by the mirrored word, and every shard gets its own index.  A query's
half is a prefix in one of the two orders, so its matches lie in one shard or in
neighbouring ones; a query that reaches over a border visits those too.  Words are
distinct, so no frequent word makes a shard larger.  Intervals of at most ``SMALL``
words are ended by comparing the located words (longer ones go on).

Words come from whole texts.  A NULL text has none; a NULL id counts as the empty
string in ``<doc_id>:<run>``; repeated rows count again; of words of equal count the
smaller one in code-point order is the form; an empty table gives an empty result.
Other columns of the input are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import ASCII_LOWER, ASCII_UPPER, materialize

# ---- fixed by the query contract ---------------------------------------------
RUN = re.compile("[A-Za-zÀ-ÿ]+")
DAMAGE = 31                  # one in so many (document, run) pairs loses a code point
MIN_LENGTH, MIN_COUNT, FORM_RATIO = 7, 2, 10
# --------------------------------------------------------------------------------
SHARD_WORDS = 25_000
SMALL = 1
HELD = 200_000               # words that a task counts before it passes them on
QUERIES = 20_000             # queries that a shard searches at once
_LOWER = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())


# --- words ------------------------------------------------------------------------

def document_words(doc_id, text: str | None) -> Counter:
    """Words of one document with their counts, after the planned deletions."""
    out = Counter()
    low = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    name = b"" if doc_id is None else str(doc_id).encode()
    for run, n in Counter(x for x in RUN.findall(low) if len(x) >= MIN_LENGTH).items():
        h = zlib.crc32(b"%b:%b" % (name, run.encode()))
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < MIN_LENGTH:
                continue
        out[run] += n
    return out


def vocabulary(df: DataFrame) -> DataFrame:
    """(word, n) of all words of df (doc_id, text) with at least two occurrences."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = Counter()
        for pdf in batches:
            for d, t in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), strict=True):
                held.update(document_words(d, t))
                if len(held) > HELD:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held = Counter()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    rows = df.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return (rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= MIN_COUNT))


# --- index --------------------------------------------------------------------------

def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order (prefix doubling); the last code is the only 0."""
    rank = codes.astype(np.int64)
    n, k = len(rank), 1
    while True:
        key = rank * (n + 1)
        key[:n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank, k = new, 2 * k
        if rank[order[-1]] == n - 1 or k >= n:
            return order


class Index:
    """FM-index over ``|w1|w2|...|wn|`` that extends a pattern to the right.

    It is the index of the mirrored text, so a step of backward search there appends a
    symbol here.  ``keys`` holds (symbol, row) of the transformed text in order: the
    interval of pattern + symbol is a pair of binary searches in it.
    """

    MARK = 1

    def __init__(self, words: list[str]):
        self.words = words
        text = "|" + "|".join(words) + "|"
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        self.alphabet, codes = np.unique(points[points != ord("|")], return_inverse=True)
        full = np.full(len(points), self.MARK, np.int64)
        full[points != ord("|")] = codes + 2
        self.symbols = len(self.alphabet) + 2
        self.marks = np.flatnonzero(points == ord("|"))
        mirrored = np.concatenate([full[::-1], [0]])
        self.start = suffix_order(mirrored)
        self.n = len(points)
        self.last = mirrored[self.start - 1]
        self.width = self.n + 2
        self.keys = np.sort(self.last * self.width + np.arange(self.n + 1))

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(codes of the words, each with a closing mark; first code of each); unknown symbols are -1."""
        points = np.frombuffer(("|".join(words) + "|").encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.alphabet, points)
        known = at < len(self.alphabet)
        known[known] = self.alphabet[at[known]] == points[known]
        codes = np.where(points == ord("|"), self.MARK, np.where(known, at + 2, -1))
        ends = np.flatnonzero(points == ord("|"))
        return codes, np.concatenate([[0], ends[:-1] + 1])

    def extend(self, lo, hi, symbol):
        """Intervals of the patterns followed by ``symbol`` (empty for unknown ones)."""
        base = symbol * self.width
        a, b = np.searchsorted(self.keys, base + lo), np.searchsorted(self.keys, base + hi)
        return a, np.where(symbol < 0, a, b)

    def located(self, rows: np.ndarray, closed: bool) -> np.ndarray:
        """Word numbers of index rows; closed: the pattern ends with the closing mark."""
        end = self.n - self.start[rows] - 1
        return np.searchsorted(self.marks, end, "right") - 1 - int(closed)

    def branches(self, lo, hi):
        """(interval number, symbol) for every symbol that follows in each interval."""
        size = hi - lo
        few = np.flatnonzero(size <= self.symbols)
        owner = np.repeat(few, size[few])
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(size[few]) - size[few], size[few])
        found = np.unique(owner * self.symbols + self.last[lo[owner] + inside])
        many = np.flatnonzero(size > self.symbols)
        found = np.concatenate([found, (many[:, None] * self.symbols + np.arange(self.symbols)).ravel()])
        return found // self.symbols, found % self.symbols


def one_error(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point turns a into b."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:                                   # length of the common prefix
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid - 1)
    return a[lo + (len(a) >= len(b)):] == b[lo + (len(b) >= len(a)):]


def search(index: Index, queries: list[str], halves: np.ndarray) -> Iterator[tuple[str, int]]:
    """(query, word number): near words that share the query's first ``halves`` code points."""
    flat, begin = index.encode(queries)
    length = np.fromiter(map(len, queries), np.int64, len(queries))
    q = np.arange(len(queries))
    zero = np.zeros(len(q), np.int64)
    lo, hi = index.extend(zero, zero + index.n + 1, zero + index.MARK)
    p, pairs = 0, []
    done = []
    while len(q):                                    # the exact half
        full = halves[q] <= p
        if full.any():
            done.append((q[full], lo[full], hi[full]))
            q, lo, hi = q[~full], lo[~full], hi[~full]
        lo, hi = index.extend(lo, hi, flat[begin[q] + p])
        keep = hi > lo
        q, lo, hi, p = q[keep], lo[keep], hi[keep], p + 1
    if not done:
        return
    q, lo, hi = (np.concatenate(x) for x in zip(*done, strict=True))
    p, err = halves[q].copy(), np.zeros(len(q), bool)
    while len(q):
        small = hi - lo <= SMALL
        if small.any():                              # few words left: compare them
            size = (hi - lo)[small]
            owner = np.repeat(q[small], size)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            rows = np.repeat(lo[small], size) + inside
            closed = np.repeat(p[small] > length[q[small]], size)
            word = np.where(closed, index.located(rows, True), index.located(rows, False))
            pairs.append(np.stack([owner, word], 1))
            q, p, lo, hi, err = (x[~small] for x in (q, p, lo, hi, err))
        over = p > length[q]                         # closing mark matched
        if (over & err).any():
            at = np.flatnonzero(over & err)
            pairs.append(np.stack([q[at], index.located(lo[at], True)], 1))
        q, p, lo, hi, err = (x[~over] for x in (q, p, lo, hi, err))
        if not len(q):
            break
        symbol = flat[begin[q] + p]
        a, b = index.extend(lo, hi, symbol)
        ahead = (err | (p < length[q])) & (b > a)    # an unchanged word is no result
        grown = [(q[ahead], p[ahead] + 1, a[ahead], b[ahead], err[ahead])]
        free = np.flatnonzero(~err)
        if len(free):
            fq, fp, flo, fhi = q[free], p[free], lo[free], hi[free]
            lacks = fp < length[fq]
            grown.append((fq[lacks], fp[lacks] + 1, flo[lacks], fhi[lacks], np.ones(lacks.sum(), bool)))
            at, s = index.branches(flo, fhi)
            other = (s > index.MARK) & (s != symbol[free][at])
            at, s = at[other], s[other]
            a, b = index.extend(flo[at], fhi[at], s)
            some = b > a
            at, a, b = at[some], a[some], b[some]
            yes = np.ones(len(at), bool)
            grown.append((fq[at], fp[at], a, b, yes))                                  # inserted
            inner = fp[at] < length[fq[at]]
            grown.append((fq[at][inner], fp[at][inner] + 1, a[inner], b[inner], yes[inner]))   # replaced
        q, p, lo, hi, err = (np.concatenate(x) for x in zip(*grown, strict=True))
    if pairs:
        for i, w in np.unique(np.concatenate(pairs), axis=0).tolist():
            if one_error(queries[i], index.words[w]):
                yield queries[i], w


# --- distributed search ---------------------------------------------------------------

def half_matches(words: DataFrame, mirrored: bool, shard_words: int) -> DataFrame:
    """(word, near, near_n): near words that agree in the left (mirrored: right) half of ``word``."""
    key = F.reverse("word") if mirrored else F.col("word")
    shards = max(1, math.ceil(words.count() / shard_words))
    placed = materialize(words.select(key.alias("key"), "n").repartitionByRange(shards, "key")
                         .withColumn("shard", F.spark_partition_id()), "variant-shards")
    # one row per shard
    bounds = sorted((r["lo"], r["hi"], r["shard"]) for r in
                    placed.groupBy("shard").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).collect())
    lows, highs, numbers = ([b[i] for b in bounds] for i in range(3))

    def half(word):                                  # the right half is the longer one
        return len(word) - len(word) // 2 if mirrored else len(word) // 2

    def guests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for w, own in zip(pdf["key"].tolist(), pdf["shard"].tolist(), strict=True):
                h = w[:half(w)]
                for s in range(bisect_left(highs, h), bisect_right(lows, h + "\U0010FFFF")):
                    if numbers[s] != own:
                        out.append((w, numbers[s]))
            if out:
                yield pd.DataFrame(out, columns=["key", "shard"])

    visiting = placed.select("key", "shard").mapInPandas(guests, "key string, shard int")

    def look(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf["n"].notna()]
        out = []
        if len(own):
            index, n = Index(own["key"].tolist()), own["n"].astype("int64").tolist()
            for s in range(0, len(pdf), QUERIES):
                part = pdf["key"].iloc[s:s + QUERIES].tolist()
                halves = np.fromiter(map(half, part), np.int64, len(part))
                out += [(q, index.words[w], n[w]) for q, w in search(index, part, halves)]
        return pd.DataFrame(out, columns=["word", "near", "near_n"]).astype({"near_n": "int64"})

    found = (placed.select("shard", "key", "n").unionByName(visiting.withColumn("n", F.lit(None).cast("long")))
             .groupBy("shard").applyInPandas(look, "word string, near string, near_n long"))
    return found.select(F.reverse("word").alias("word"), F.reverse("near").alias("near"), "near_n") if mirrored else found


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, near, near_n): every ordered pair of near words of the table words (word, n)."""
    return half_matches(words, False, shard_words).union(half_matches(words, True, shard_words)).distinct()


def spelling_groups(df: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of df (doc_id, text)."""
    words = materialize(vocabulary(df), "vocabulary")
    near = near_words(words, shard_words)
    best = F.struct(-F.col("near_n"), F.col("near"))
    around = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(best).alias("best"))
    found = words.join(around, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.col1") >= FORM_RATIO * F.col("n"), F.struct(F.col("best.near").alias("form"),
                                                                     (-F.col("best.col1")).alias("form_n"))).alias("f"))
    found = materialize(found.select("word", "n", "n_near", "f.form", "f.form_n"), "variants")
    # the count grows tenfold with every step, so a chain is as short as the largest count has digits
    digits = len(str(words.agg(F.max("n")).first()[0] or 1))
    jump = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(digits + 1)))):
        step = jump.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jump = materialize(jump.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return found.join(jump, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"),
                                                   "n", "n_near", "form_n")


def op13(df: DataFrame) -> DataFrame:
    return spelling_groups(df.select("doc_id", "text"))
