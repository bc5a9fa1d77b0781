"""Operator 4: weighted near-duplicates by improved consistent weighted sampling.

A text is the weighted set of its five-word shingles; the weight is the shingle's
count times the mean inverse document frequency of its words.  Word document
frequencies are counted over all texts, by word hash into 2^17 buckets, so the table
that every task needs has a fixed size.  (Frequencies of whole shingles would make a
shingle shared by many copies nearly weightless and tear their groups apart.)

Improved consistent weighted sampling draws HASHES samples per text; two texts agree in
a sample with a probability equal to their weighted Jaccard similarity.  BANDS bands of
ROWS samples make buckets.  Inside a bucket every text is compared with the one of the
smallest id; where a bucket still holds more than one component, its other pairs are
screened by their samples and compared, block against block, so that no group meets in
one task, until the components are linked.  Every link is verified by the exact
weighted Jaccard similarity of the whole texts; n_links counts the links found, which
span each class but are not all its pairs.

Equal texts are one node (64-bit text hash) and are never expanded into pairs.
Nulls: a NULL text is alone in its class.  Texts without words only match equal texts;
texts of one to four words count as one shingle.  A NULL id sorts after all others.
Repeated rows share a class.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import components, materialize, mix64, release, releasing, shingle_hashes, slices, words_of

BANDS, ROWS = 16, 4
HASHES = BANDS * ROWS
DF_BITS = 17
POOL_BITS = 13           # rows of the table of random draws that shingle hashes pick from
THRESHOLD = 0.8
SCREEN = 0.58            # share of equal samples below which a pair is not verified (4.4 sigma under 0.8)
BLOCK = 500
SLICE = 400_000          # characters hashed at once; every one takes some 40 bytes of a task
_draws: tuple | None = None


def draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(r, log c, beta) of the sampling scheme, one row per pool entry."""
    global _draws
    if _draws is None:
        rng = np.random.default_rng(4242)
        shape = (1 << POOL_BITS, HASHES)
        r = rng.gamma(2.0, 1.0, shape).astype(np.float32)
        _draws = r, np.log(rng.gamma(2.0, 1.0, shape)).astype(np.float32), rng.random(shape, np.float32)
    return _draws


def text_sets(texts: list, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(sorted distinct shingles, counts, weight of one occurrence) of each text."""
    words, _, first, _ = words_of(texts)
    value = idf[(words >> np.uint64(64 - DF_BITS)).astype(np.int64)]
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        w = words[a:b]
        k = min(5, len(w))
        if not k:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)))
            continue
        mean = np.convolve(value[a:b], np.full(k, 1.0 / k), "valid")
        s, at, n = np.unique(shingle_hashes(w, k), return_index=True, return_counts=True)
        out.append((s, n, mean[at]))
    return out


def sample(shingles: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """One 32-bit value per hash function: the sampled (shingle, level)."""
    r_all, c_all, b_all = draws()
    best = np.full(HASHES, np.inf, np.float32)
    value = np.zeros(HASHES, np.uint64)
    log_w = np.log(weight).astype(np.float32)[:, None]
    row = (shingles & np.uint64((1 << POOL_BITS) - 1)).astype(np.int64)
    for s in range(0, len(shingles), 4096):
        i = row[s:s + 4096]
        r, beta = r_all[i], b_all[i]
        level = np.floor(log_w[s:s + 4096] / r + beta)
        a = c_all[i] - r * (level - beta + np.float32(1))
        at = a.argmin(0)
        low = a[at, np.arange(HASHES)]
        better = low < best
        best[better] = low[better]
        picked = mix64(shingles[s:s + 4096][at] + level[at, np.arange(HASHES)].astype(np.int64).astype(np.uint64))
        value[better] = picked[better]
    return value.astype(np.uint32)


def similarity(x, y) -> float:
    """Weighted Jaccard similarity of two text sets."""
    (s, n, w), (t, m, v) = x, y
    total = float(n @ w + m @ v)
    _, i, j = np.intersect1d(s, t, assume_unique=True, return_indices=True)
    both = float(np.minimum(n[i] * w[i], m[j] * v[j]).sum())
    return both / (total - both) if total > both else float(len(s) > 0)


def word_idf(df: DataFrame, text: str = "text") -> np.ndarray:
    """Inverse document frequency per word-hash bucket over all texts (2^17 numbers)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(1 << DF_BITS, np.int64)
        for pdf in batches:
            texts = pdf[text].tolist()
            for s, e in slices(texts, SLICE):
                words, owner, _, _ = words_of(texts[s:e])
                pair = np.unique(owner.astype(np.int64) << DF_BITS | (words >> np.uint64(64 - DF_BITS)).astype(np.int64))
                seen += np.bincount(pair & ((1 << DF_BITS) - 1), minlength=1 << DF_BITS)
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"bucket": at.astype(np.int32), "n": seen[at]})

    got = df.select(text).mapInPandas(releasing(count), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(1 << DF_BITS)
    seen[got["bucket"]] = got["n"]
    return np.log1p(max(1, df.count()) / np.maximum(seen, 1.0))


def near_links(df: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(nodes: node, doc, rows), (links: a, b, similarity) over the distinct texts of df (doc_id, text)."""
    spark = df.sparkSession
    idf = spark.sparkContext.broadcast(word_idf(df))           # fixed size: 2^17 doubles

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for s, e in slices(texts, SLICE):
                part, sets = pdf.iloc[s:e], text_sets(texts[s:e], idf.value)
                yield pd.DataFrame({"doc": part["doc"], "node": part["node"], "sig": [
                    sample(x, n * w).tobytes() if len(x) else None for x, n, w in sets]})

    rows = df.where(F.col("text").isNotNull()).select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("node"), "text")
    signed = materialize(rows.mapInPandas(releasing(sign), "doc long, node long, sig binary"), "signatures")
    last = F.lit((1 << 63) - 1)
    nodes = materialize(signed.groupBy("node").agg(
        F.min("doc").alias("doc"), F.count(F.lit(1)).alias("rows"), F.any_value("sig").alias("sig")), "nodes")

    width = 4 * ROWS
    bands = F.array(*[F.xxhash64(F.lit(b), F.substring("sig", b * width + 1, width)) for b in range(BANDS)])
    slots = nodes.where(F.col("sig").isNotNull()).select(
        "node", F.coalesce("doc", last).alias("doc"), F.posexplode(bands).alias("band", "key"))
    head = F.min_by("node", F.struct("doc", "node"))
    # stored first: Spark can split the hot keys of a join of two plain shuffles
    centre = materialize(slots.groupBy("key").agg(head.alias("centre"), F.count(F.lit(1)).alias("n")).where("n > 1"), "centres")
    slots = materialize(slots.drop("doc").join(centre, "key"), "slots")
    # texts of the nodes that share a bucket, by one shuffle at every size
    texts = materialize(rows.select("node", "text").join(slots.select("node").distinct().hint("merge"), "node", "left_semi")
                        .dropDuplicates(["node"]), "texts")
    star = (slots.where("node <> centre")
            .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())
    first = materialize(verify(star, texts, idf, threshold), "star-links")

    # buckets that hold three or more texts of several components: the pairs a star leaves out
    label = components(first)
    named = materialize(slots.where("n > 2").select("key", "band", "node").join(
        label.select("node", F.col("root").alias("comp")), "node", "left").withColumn("comp", F.coalesce("comp", "node")), "named")
    mixed = (named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n"))
             .where("lo <> hi").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    rest = named.join(materialize(mixed, "mixed"), "key").join(nodes.select("node", "sig"), "node").join(texts, "node")
    mine = F.pmod(F.xxhash64("node", F.lit(9)), F.col("blocks")).cast("int")
    dealt = (rest.withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "band", "node", "comp", "sig", "text", "mine",
                     F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            return pd.DataFrame(block_links(pdf, idf.value, threshold), columns=["a", "b", "similarity"])
        finally:
            if len(pdf) > BLOCK // 2:
                release()

    second = materialize(dealt.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long, similarity double"), "more-links")
    return nodes, first.union(second)


def block_links(pdf: pd.DataFrame, idf: np.ndarray, threshold: float) -> list[tuple[int, int, float]]:
    """Links between components inside one pair of blocks of a bucket, exactly verified.

    Pairs are screened by their samples and handled in the first band they share.  Once
    two components are linked, their other pairs need no test, so the links found
    join all components that any pair joins.
    """
    pdf = pdf.sort_values("node").reset_index(drop=True)
    sig = np.frombuffer(b"".join(pdf["sig"]), np.uint32).reshape(len(pdf), HASHES)
    node, comp, mine = (pdf[c].to_numpy() for c in ("node", "comp", "mine"))
    i, j, band = (int(pdf[c].iloc[0]) for c in ("i", "j", "band"))
    sets: dict[int, tuple] = {}
    root = {c: c for c in comp.tolist()}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    def weighted(k):
        if k not in sets:
            sets[k] = text_sets([pdf["text"].iat[k]], idf)[0]
        return sets[k]

    left, right, out = np.flatnonzero(mine == i), np.flatnonzero(mine == j), []
    for x in left.tolist():
        y = right[right > x] if i == j else right
        y = y[comp[y] != comp[x]]
        same = sig[y] == sig[x]
        share = same.sum(1)
        ok = (share >= SCREEN * HASHES) & (same.reshape(-1, BANDS, ROWS).all(2).argmax(1) == band)
        y, share = y[ok], share[ok]
        for k in y[np.argsort(-share, kind="stable")].tolist():
            cx, cy = find(comp[x].item()), find(comp[k].item())
            if cx != cy:
                value = similarity(weighted(x), weighted(k))
                if value >= threshold:
                    root[cx] = cy
                    out.append((min(int(node[x]), int(node[k])), max(int(node[x]), int(node[k])), value))
    return out


def verify(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """The pairs (a, b) of text hashes whose texts reach the threshold, with their similarity."""
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for s, e in slices((pdf["ta"] + pdf["tb"]).tolist(), SLICE):
                part = pdf.iloc[s:e]
                seen = dict(zip(part["a"], part["ta"], strict=True)) | dict(zip(part["b"], part["tb"], strict=True))
                sets = dict(zip(seen, text_sets(list(seen.values()), idf.value), strict=True))
                j = np.asarray([similarity(sets[a], sets[b]) for a, b in zip(part["a"], part["b"], strict=True)], float)
                ok = j >= threshold
                yield pd.DataFrame({"a": part["a"].to_numpy()[ok], "b": part["b"].to_numpy()[ok], "similarity": j[ok]})

    return both.mapInPandas(releasing(check), "a long, b long, similarity double")


def classes(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """node, doc, rows, class_node, class_id, class_rows, n_links of every distinct text."""
    nodes, links = near_links(df, threshold)
    links = materialize(links, "links")
    root = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    member = (nodes.select("node", "doc", "rows").join(root, "node", "left").join(degree, "node", "left")
              .withColumn("root", F.coalesce("root", "node")))
    member = materialize(member.withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long"))), "members")
    order = F.struct(F.col("doc").isNull(), "doc", "node")
    head = member.groupBy("root").agg(F.min_by(F.struct("doc", "node"), order).alias("h"), F.sum("rows").alias("class_rows"))
    return member.join(head, "root").select("node", "doc", "rows", F.col("h.node").alias("class_node"),
                                            F.col("h.doc").alias("class_id"), "class_rows", "n_links")


def op4(df: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its class), class_size, n_links of every row."""
    base = df.select("doc_id", "text")
    found = classes(base).select("node", "class_id", F.col("class_rows").alias("class_size"), "n_links")
    named = (base.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("node"))
             .join(found, "node").select("doc_id", "class_id", "class_size", "n_links"))
    alone = base.where(F.col("text").isNull()).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(0).cast("long").alias("n_links"))
    return named.union(alone)


def deduplicated(df: DataFrame) -> DataFrame:
    """One row of each class: of the smallest id; rows with a NULL text stay.

    The winner is chosen by (text hash, id) alone, so no aggregation holds whole rows; of
    repeated rows (same id and text) one stays.
    """
    # the row travels as one struct, so that its columns clash with nothing
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col("doc_id").alias("_id"),
                     F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("_node"))
    found = classes(df.select("doc_id", "text")).where("node = class_node").select(F.col("node").alias("n"), F.col("doc").alias("d"))
    same = (F.col("n") == F.col("_node")) & F.col("d").eqNullSafe(F.col("_id"))
    times = df.where(F.col("text").isNotNull()).groupBy(F.xxhash64("text").alias("_node"), F.col("doc_id").alias("_id")).count()
    kept = materialize(found.join(times, same).select("n", "d", (F.col("count") > 1).alias("_many")), "kept")
    stay = rows.where(F.col("_node").isNotNull()).join(kept, same)
    once = stay.where(~F.col("_many")).select("_row.*")
    first = stay.where("_many").dropDuplicates(["_node", "_id"]).select("_row.*")
    return once.union(first).union(rows.where(F.col("_node").isNull()).select("_row.*"))
