"""Operator 12: collocations by marginalising the longest windows with ROLLUP.

A text is cut into pieces and words, and every word leads one window: itself and the
three words after it, padded with NULL at the end of its piece.  Only these windows are
counted.  Each phrase of one to four words is a prefix of windows, so one Spark ROLLUP
over the four lead columns sums the windows to the counts of all shorter phrases; no
phrase of another length is ever listed.

Words travel as 64-bit hashes of (language, word).  The table of words, grouped by hash,
shows any two words of one hash; the job then starts again with another seed, so equal
hashes always mean equal words.

A phrase with at least ``min_count`` occurrences only holds words and shorter phrases with
as many, so a window ends before the word at which it is proven rarer.  The proof is
a count per hash bucket (never below the true count); the bitmaps of frequent buckets
grow with the corpus up to a fixed size (2^28 bits).  They only shorten windows that can't matter: the
results are the same without them, at any size.

Everything is per language (NULL: ``und``).  A NULL text is empty; repeated rows count
again; ties are ordered as the contract says; an empty table gives an empty result;
other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import materialize, mix64, run_hashes, slices

# ---- fixed by the query contract ---------------------------------------------
LONGEST, MIN_COUNT, SCALE, TOP = 4, 30, 2_000_000, 2000
COVER_PART, COVER_WHOLE = 100, 80          # drop if 100 f(longer) >= 80 f
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
# --------------------------------------------------------------------------------
LEAST_BITS, MOST_BITS, CELL_BITS = 20, 28, 18
HELD_GRAMS = 6_000_000            # phrases that a task counts before it passes them on
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[list(PIECE_ENDS)] = True
_GAP = _BREAK.copy()
_GAP[list(BLANKS)] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)


def cut(texts: list, langs: list, seed: int):
    """(bytes, first byte and end of each word, hash of (language, word), piece number) of many texts."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    ok = ~_GAP[data]
    edge = np.diff(ok.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.searchsorted(np.flatnonzero(_BREAK[data]), starts)
    base = np.cumsum([0] + [len(r) + 1 for r in raw])
    owner = np.searchsorted(base, starts, "right") - 1
    named = {l: run_hashes(np.frombuffer(l.encode("utf-8", "surrogatepass") or b"\0", np.uint8), np.array([0]),
                           np.array([max(1, len(l.encode("utf-8", "surrogatepass")))]))[0] for l in set(langs)}
    tag = np.fromiter((named[l] for l in langs), np.uint64, len(langs))
    with np.errstate(over="ignore"):
        hashes = mix64(run_hashes(data, starts, ends) * _STEP + tag[owner] + np.uint64(seed))
    hashes[hashes == 0] = np.uint64(1)               # 0 is the padding
    return data, starts, ends, hashes, owner, piece


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(a * _STEP + b)


def word_table(rows: DataFrame, seed: int) -> DataFrame:
    """(id, lang, word, n): all words with their hashes."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, langs = pdf["text"].tolist(), pdf["lang"].tolist()
            for s, e in slices(texts):
                data, starts, ends, hashes, owner, _ = cut(texts[s:e], langs[s:e], seed)
                if not len(hashes):
                    continue
                ids, at, n = np.unique(hashes, return_index=True, return_counts=True)
                body = data.tobytes()
                words = [body[a:b].decode("utf-8", "surrogatepass")
                         for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                yield pd.DataFrame({"id": ids.view(np.int64), "lang": [langs[s + i] for i in owner[at].tolist()],
                                    "word": words, "n": n})

    return (rows.mapInPandas(count, "id long, lang string, word string, n long")
            .groupBy("id", "lang", "word").agg(F.sum("n").alias("n")))


def frequent_words(words: DataFrame, bits: int, least: int) -> np.ndarray:
    """Packed bitmap of the hash buckets that hold a word of at least ``least`` occurrences."""
    low = (1 << bits) - 1
    cell = F.col("id").bitwiseAND(F.lit(low))
    marks = words.where(F.col("n") >= least).select(F.shiftright(cell, CELL_BITS).alias("cell"),
                                                    cell.bitwiseAND(F.lit((1 << CELL_BITS) - 1)).alias("bit"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        on = np.zeros(1 << CELL_BITS, bool)
        on[pdf["bit"].to_numpy()] = True
        return pd.DataFrame({"cell": pdf["cell"].iloc[:1], "map": [zstandard.compress(np.packbits(on).tobytes(), 1)]})

    return _assembled(marks.distinct().groupBy("cell").applyInPandas(pack, "cell long, map binary").collect(), bits)   # at most 2^MOST_BITS bits


def _assembled(maps: list, bits: int) -> np.ndarray:
    out = np.zeros((1 << bits) // 8, np.uint8)
    size = (1 << CELL_BITS) // 8
    for r in maps:
        out[r["cell"] * size:(r["cell"] + 1) * size] = np.frombuffer(zstandard.decompress(r["map"]), np.uint8)
    return out


def _on(bitmap: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    at = (hashes & np.uint64((1 << bits) - 1)).astype(np.int64)
    return (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def gram_hashes(h: np.ndarray, ok: np.ndarray, piece: np.ndarray):
    """(order, first word of each phrase of known words inside a piece, its hash) for orders 2 to 4."""
    at, value = np.flatnonzero(ok), h[ok]
    for k in range(2, LONGEST + 1):
        inside = at + k - 1 < len(h)
        at, value = at[inside], value[inside]
        joined = ok[at + k - 1] & (piece[at] == piece[at + k - 1])
        at, value = at[joined], pair_hash(value[joined], h[at[joined] + k - 1])
        yield k, at, value


def frequent_grams(rows: DataFrame, seed: int, known, bits: int, least: int) -> list[np.ndarray]:
    """Packed bitmaps, for phrases of two to four words, of the hash buckets that add up to ``least``.

    A task passes on its bucket counts in packed cells of 2^18 buckets; a cell's arrays are
    added up in one task, so a frequent phrase is one number there.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        zip_ = zstandard.ZstdCompressor(level=1)

        def cells(held):
            for k, parts in held.items():
                at, n = np.unique(np.concatenate(parts), return_counts=True)
                n = np.minimum(n, least).astype(np.uint16)
                cell = at >> CELL_BITS
                first = np.flatnonzero(np.diff(cell, prepend=-1))
                for a, b in zip(first.tolist(), [*first[1:].tolist(), len(at)], strict=True):
                    inner = (at[a:b] & ((1 << CELL_BITS) - 1)).astype(np.uint32)
                    gaps = np.diff(inner, prepend=np.uint32(0)).astype(np.uint32)
                    packed = gaps.view(np.uint8).reshape(-1, 4).T.tobytes() + n[a:b].tobytes()
                    yield pd.DataFrame({"size": [k], "cell": [int(cell[a])], "n": [b - a], "packed": [zip_.compress(packed)]})

        held, room = {}, HELD_GRAMS
        for pdf in batches:
            texts, langs = pdf["text"].tolist(), pdf["lang"].tolist()
            for s, e in slices(texts):
                _, _, _, h, _, piece = cut(texts[s:e], langs[s:e], seed)
                for k, at, value in gram_hashes(h, _on(known.value, bits, h), piece):
                    if len(at):
                        held.setdefault(k, []).append((value & np.uint64((1 << bits) - 1)).astype(np.int32))
                        room -= len(at)
                if room < 0:
                    yield from cells(held)
                    held, room = {}, HELD_GRAMS
        yield from cells(held)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << CELL_BITS, np.int64)
        unzip = zstandard.ZstdDecompressor()
        for size, packed in zip(pdf["n"].tolist(), pdf["packed"], strict=True):
            body = unzip.decompress(packed)
            gaps = np.frombuffer(body, np.uint8, 4 * size).reshape(4, size).T.copy().view(np.uint32).ravel()
            total[np.cumsum(gaps, dtype=np.int64)] += np.frombuffer(body, np.uint16, size, 4 * size)
        return pd.DataFrame({"size": pdf["size"].iloc[:1], "cell": pdf["cell"].iloc[:1],
                             "map": [zstandard.compress(np.packbits(total >= least).tobytes(), 1)]})

    found = rows.mapInPandas(count, "size int, cell long, n int, packed binary")
    maps = found.groupBy("size", "cell").applyInPandas(add, "size int, cell long, map binary").collect()   # at most 3 * 2^MOST_BITS bits
    return [_assembled([r for r in maps if r["size"] == k], bits) for k in range(2, LONGEST + 1)]


def lead_windows(rows: DataFrame, seed: int, known, grams, bits: int) -> DataFrame:
    """(w1, w2, w3, w4, n): the longest window of every word, padded with NULL."""
    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, langs = pdf["text"].tolist(), pdf["lang"].tolist()
            for s, e in slices(texts):
                _, _, _, h, _, piece = cut(texts[s:e], langs[s:e], seed)
                ok = _on(known.value, bits, h)
                lead = [np.where(ok, h, 0).astype(np.uint64)]
                go = ok
                for (k, at, value), bitmap in zip(gram_hashes(h, ok, piece), grams.value, strict=True):
                    frequent = np.zeros(len(h), bool)
                    frequent[at[_on(bitmap, bits, value)]] = True
                    go = go & frequent
                    lead.append(np.where(go, np.concatenate([h[k - 1:], np.zeros(min(k - 1, len(h)), np.uint64)])[:len(h)], 0).astype(np.uint64))
                alone, times = np.unique(lead[0][ok & (lead[1] == 0)], return_counts=True)
                long = lead[1] != 0
                cols = [np.concatenate([x[long], alone if i == 0 else np.zeros(len(alone), np.uint64)]).view(np.int64)
                        for i, x in enumerate(lead)]
                out = pd.DataFrame({f"w{i + 1}": x for i, x in enumerate(cols)})
                yield out.assign(n=np.concatenate([np.ones(int(long.sum()), np.int64), times]))

    got = rows.mapInPandas(windows, ", ".join(f"w{i} long" for i in range(1, LONGEST + 1)) + ", n long")
    return got.select(*[F.nullif(F.col(f"w{i}"), F.lit(0)).alias(f"w{i}") for i in range(1, LONGEST + 1)], "n")


def phrase_counts(windows: DataFrame, least: int) -> DataFrame:
    """(phrase array<long>, f): all phrases of one to four words with at least ``least`` occurrences."""
    lead = [f"w{i}" for i in range(1, LONGEST + 1)]
    whole = windows.groupBy(*lead).agg(F.sum("n").alias("n"))
    summed = whole.rollup(*lead).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    size = F.lit(LONGEST) - F.bit_count("g")
    # a row of k words is one whose k-th word is neither padding nor summed over
    return (summed.where(F.col("f") >= least).where("w1 IS NOT NULL")
            .select(F.filter(F.array(*lead), lambda x: x.isNotNull()).alias("phrase"), "f", size.alias("k"))
            .where(F.size("phrase") == F.col("k")).select("phrase", "f"))


def collocations(df: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language of df (lang, text)."""
    spark = df.sparkSession
    rows = df.where(F.col("text").isNotNull()).select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    seed = 0
    while True:
        words = materialize(word_table(rows, seed), "words")
        if not words.groupBy("id").count().where("count > 1").limit(1).count():
            break
        seed += 1
    total = words.agg(F.sum("n")).first()[0] or 1
    bits = min(MOST_BITS, max(LEAST_BITS, int(total // 4).bit_length()))
    known = spark.sparkContext.broadcast(frequent_words(words, bits, min_count))
    grams = spark.sparkContext.broadcast(frequent_grams(rows, seed, known, bits, min_count))
    counts = materialize(phrase_counts(lead_windows(rows, seed, known, grams, bits), min_count), "phrases")
    kept = materialize(score(counts), "candidates")

    names = words.where(F.col("n") >= min_count).select("id", "lang", "word")
    spelt = (kept.select("phrase", F.posexplode("phrase").alias("at", "id")).join(names, "id").groupBy("phrase")
             .agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
             .select("phrase", "lang", F.concat_ws(" ", F.transform("w", lambda x: x["word"])).alias("spelt")))
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (kept.join(spelt, "phrase").select("lang", F.col("spelt").alias("phrase"), "a", "l", "r", "score")
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def score(counts: DataFrame) -> DataFrame:
    """(phrase, a, l, r, score) of the candidates that no longer candidate covers."""
    size = F.size("phrase")
    wide = "decimal(38,0)"
    cand = counts.where(size >= 2).withColumnRenamed("f", "a")
    cuts = (cand.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
            .select("phrase", "a", "k", F.slice("phrase", F.lit(1), F.col("k")).alias("first"),
                    F.expr("slice(phrase, k + 1, size(phrase) - k)").alias("rest")))
    parts = (cuts.join(counts.select(F.col("phrase").alias("first"), F.col("f").alias("l")), "first")
             .join(counts.select(F.col("phrase").alias("rest"), F.col("f").alias("r")), "rest"))
    # decimals: 2,000,000 a may pass 64 bits; the quotient is at most 1,000,000
    scored = parts.withColumn("score", F.expr(f"CAST(({SCALE} * CAST(a AS decimal(20,0))) div (CAST(l AS {wide}) + r) AS LONG)"))
    lowest = scored.groupBy("phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    inner = cand.where(size >= 3).select(F.col("a").alias("whole"), F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1), lambda m: F.transform(
            F.sequence(F.lit(1), F.size("phrase") - m + 1), lambda i: F.slice("phrase", i, m))))).alias("phrase"))
    cover = inner.groupBy("phrase").agg(F.max("whole").alias("whole"))
    return (lowest.join(cover, "phrase", "left")
            .where(f"whole IS NULL OR {COVER_PART} * CAST(whole AS {wide}) < {COVER_WHOLE} * CAST(a AS {wide})")
            .select("phrase", "a", "m.l", "m.r", "m.score"))


def op12(df: DataFrame) -> DataFrame:
    return collocations(df.select("lang", "text")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
