"""Operator 7: benchmark decontamination by size-partitioned MinHash containment search (native).

Finds short benchmark items inside long documents.  A document is a sequence of
blocks of up to BLOCK consecutive word shingles; blocks and items carry MinHash
signatures.  Blocks are partitioned by size.  For a block of at most u shingles and an
item of q shingles, a containment of ``threshold`` implies a Jaccard similarity of at
least s(u, q) with the blocks it spans, and only as many hash functions are
compared as s needs for a recall of RECALL.  Items of up to SHORT shingles are joined to
the documents by their shingles instead.  Candidates are verified by exact
containment of the item's distinct shingles in the whole document.

The hash functions flip the bits of one 64-bit shingle hash with constants whose
leading bits differ, so each takes its minimum in another part of the hash range
(one-permutation MinHash whose empty parts borrow from the nearest one).  The first b
of them, all that a longer item compares, lie evenly over the whole range.

Shingles are five consecutive lower-case words of letters and digits.  Items of
fewer than five words, and NULL texts, have none and match nothing; a NULL item id is
kept.  Rows with equal (doc_id, text) count once.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import materialize

K = 5
BLOCK = 32
PARTITIONS = (8, 16, 32)          # upper block sizes
RECALL = 0.999
SHORT = 5                         # items of up to so many shingles are joined by shingle
BROADCAST_ROWS = 1_000_000        # rows of up to 40 bytes; beyond it Spark joins by shuffle


def with_shingles(df: DataFrame, text: str, k: int = K) -> DataFrame:
    """``df`` with ``_s``: the 64-bit hashes of the text's k-word shingles, in order."""
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    # exploding a one-element array keeps the optimizer from copying the split into every use of it
    hashed = df.select("*", F.explode(F.array(F.transform(words, lambda w: F.xxhash64(w)))).alias("_w"))
    run = F.slice("_w", F.lit(1), F.greatest(F.size("_w") - F.lit(k - 1), F.lit(0)))
    shingles = F.transform(run, lambda w, i: F.xxhash64(w, *[F.get("_w", i + j) for j in range(1, k)]))
    return hashed.select("*", F.explode(F.array(shingles)).alias("_s")).drop("_w")


def flips(n: int) -> list[int]:
    """Signed 64-bit constants with different leading bits, of which every prefix covers the hash range evenly."""
    lead = max(1, math.ceil(math.log2(max(2, n))))
    low = np.random.default_rng(77).integers(0, 2**64, n, dtype=np.uint64)
    raw = [(int(f"{k:0{lead}b}"[::-1], 2) << (64 - lead)) | (int(x) >> lead) for k, x in enumerate(low)]
    return [r - (1 << 64) if r >> 63 else r for r in raw]


def hashes_needed(u: int, q: int, threshold: float) -> int:
    """Hash functions that find an item of q shingles in blocks of up to u with RECALL."""
    spans = (q + BLOCK - 2) // BLOCK + 1
    shared = min(u, threshold * q / spans)
    s = shared / (u + q - shared)
    if s >= 1:
        return 1
    return max(1, math.ceil(math.log(1 - RECALL) / (spans * math.log(1 - s))))


def _flip(c: int):
    return lambda x: x.bitwiseXOR(F.lit(c))


def size_class(n: Column) -> Column:
    out = F.lit(PARTITIONS[-1])
    for u in reversed(PARTITIONS[:-1]):
        out = F.when(n <= u, F.lit(u)).otherwise(out)
    return out


def small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint where the counted rows are within the bound; else as it is."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.8, text: str = "text",
                 id_col: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """doc_id, _text_hash, item_id, n_shared, n_item, containment of every match."""
    item = with_shingles(items.select(F.col(item_id).alias("item_id"), F.col(text).alias("_t")), "_t")
    item = materialize(item.select("item_id", F.xxhash64("_t").alias("_item"), F.array_distinct("_s").alias("_s"))
                       .where(F.size("_s") > 0).withColumn("n_item", F.size("_s")).distinct(), "items")
    stat = item.groupBy("n_item").agg(F.count(F.lit(1)).alias("n")).collect()     # one row per item size
    need = {(u, r["n_item"]): hashes_needed(u, r["n_item"], threshold) for u in PARTITIONS for r in stat if r["n_item"] > SHORT}
    per_class = {u: max([b for (v, _), b in need.items() if v == u], default=0) for u in PARTITIONS}
    n_hash = max([*per_class.values(), 1])
    flip = flips(n_hash)
    item_rows = sum(r["n"] * r["n_item"] for r in stat)
    key_rows = sum(r["n"] * need.get((u, r["n_item"]), 0) for u in PARTITIONS for r in stat)
    short_rows = sum(r["n"] * r["n_item"] for r in stat if r["n_item"] <= SHORT)

    doc = with_shingles(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("_text_hash"),
                                    F.col(text).alias("_t")), "_t").drop("_t")
    doc = doc.where(F.size("_s") > 0)

    # signatures of blocks: one minimum per hash function, combined before the shuffle
    blocks = (doc.select("doc_id", "_text_hash", F.size("_s").alias("n_doc"), F.posexplode("_s").alias("pos", "x"))
              .groupBy("doc_id", "_text_hash", "n_doc", F.floor(F.col("pos") / BLOCK).cast("int").alias("block"))
              .agg(F.count(F.lit(1)).alias("n"), *[F.min(F.col("x").bitwiseXOR(F.lit(c))).alias(f"m{k}")
                                                   for k, c in enumerate(flip)]))
    # repeated rows of one document only make a block larger, never its minima different
    u = size_class(F.least(F.col("n"), F.lit(BLOCK)))
    depth = F.create_map(*[x for v, b in per_class.items() for x in (F.lit(v), F.lit(b))])
    probes = (blocks.select("doc_id", "_text_hash", "n_doc", u.alias("u"), F.array(*[f"m{k}" for k in range(n_hash)]).alias("m"))
              .select("doc_id", "_text_hash", "n_doc", "u", F.posexplode(F.slice("m", F.lit(1), depth[F.col("u")])).alias("k", "v")))
    signature = F.array(*[F.array_min(F.transform("_s", _flip(c))) for c in flip])
    takes = F.create_map(*([y for (v, q), b in need.items() for y in (F.lit(v * (1 << 32) + q), F.lit(b))] or
                           [F.lit(0), F.lit(0)]))
    asked = (item.where(F.col("n_item") > SHORT).select("item_id", "_item", "n_item", signature.alias("m"),
                         F.explode(F.array(*map(F.lit, PARTITIONS))).alias("u"))
             .withColumn("b", takes[F.col("u").cast("long") * F.lit(1 << 32) + F.col("n_item")])
             .select("item_id", "_item", "n_item", "u", F.posexplode(F.slice("m", F.lit(1), F.col("b"))).alias("k", "v")))
    pairs = (probes.join(small(asked, key_rows), ["u", "k", "v"]).where(F.col("n_doc") >= F.lit(threshold) * F.col("n_item"))
             .select("doc_id", "_text_hash", "item_id", "_item", "n_item").distinct())
    if short_rows:          # too few shingles for a minimum to fall on: joined by each of them
        few = (item.where(F.col("n_item") <= SHORT)
               .select("item_id", "_item", "n_item", F.explode("_s").alias("x")))
        held = doc.select("doc_id", "_text_hash", F.explode(F.array_distinct("_s")).alias("x"))
        pairs = pairs.union(held.join(small(few, short_rows), "x").select("doc_id", "_text_hash", "item_id", "_item", "n_item").distinct())
    pairs = materialize(pairs, "candidates")

    # exact containment, over the candidate documents only
    hit = pairs.select("doc_id", "_text_hash").distinct()
    own = (doc.join(small(hit, hit.count()), _same("doc_id", doc, hit) & (doc["_text_hash"].eqNullSafe(hit["_text_hash"])), "left_semi")
           .select("doc_id", "_text_hash", F.explode(F.array_distinct("_s")).alias("x")).distinct())
    wanted = item.select(F.col("_item").alias("_i2"), F.col("item_id").alias("_id2"), F.explode("_s").alias("x"))
    shared = own.join(small(wanted, item_rows), "x").groupBy(
        F.col("doc_id").alias("_d2"), F.col("_text_hash").alias("_h2"), "_id2", "_i2").agg(F.count(F.lit(1)).alias("n_shared"))
    return (pairs.join(shared, F.col("doc_id").eqNullSafe(F.col("_d2")) & F.col("_text_hash").eqNullSafe(F.col("_h2"))
                       & F.col("item_id").eqNullSafe(F.col("_id2")) & (F.col("_item") == F.col("_i2")))
            .where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item"))
            .select("doc_id", "_text_hash", "item_id", "n_shared", F.col("n_item").cast("long").alias("n_item"),
                    (F.col("n_shared") / F.col("n_item")).alias("containment")))


def _same(name: str, a: DataFrame, b: DataFrame) -> Column:
    return a[name].eqNullSafe(b[name])


def op7(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contaminated(docs, items).drop("_text_hash")


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item."""
    bad = materialize(contaminated(docs, items).select("doc_id", "_text_hash").distinct(), "contaminated")
    bad = small(bad.select(F.col("doc_id").alias("_bad_id"), F.col("_text_hash").alias("_bad_hash")), bad.count())
    # the row travels as one struct, so that its columns clash with nothing
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"),
                       F.xxhash64("text").alias("_hash"))
    return rows.join(bad, F.col("_id").eqNullSafe(F.col("_bad_id")) & (F.col("_hash") == F.col("_bad_hash")), "left_anti").select("_row.*")


ORACLE = r"""
WITH d AS (SELECT DISTINCT doc_id, text, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
ds AS (SELECT DISTINCT doc_id, text, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM d),
b AS (SELECT DISTINCT item_id, text, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
bs AS (SELECT DISTINCT item_id, text, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM b),
q AS (SELECT item_id, text, count(*) AS n_item FROM bs GROUP BY ALL),
m AS (SELECT doc_id, ds.text AS dt, item_id, bs.text AS bt, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY ALL)
SELECT doc_id, m.item_id, n_shared, n_item, n_shared / n_item AS containment
FROM m JOIN q ON m.item_id IS NOT DISTINCT FROM q.item_id AND m.bt = q.text WHERE n_shared >= 0.8 * n_item
"""
