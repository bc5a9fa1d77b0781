"""Shared helpers: shared-storage tables, byte-level word hashing, components."""

from __future__ import annotations

import ctypes
import functools
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"          # fixed by the query contracts: a word
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a private one only for local masters without a setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        from flowlens.session import ensure_checkpoint_dir
        base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/llm"


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give freed memory back to the system: Python workers stay alive between stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim:
        trim(0)


def releasing(batches_to_batches):
    """A map function over batches that releases its memory when its partition is done."""
    @functools.wraps(batches_to_batches)
    def run(batches):
        try:
            yield from batches_to_batches(batches)
        finally:
            release()
    return run


def part_count(df: DataFrame, per_part: int, rows: int | None = None) -> int:
    n = df.count() if rows is None else rows
    return max(1, -(-n // per_part))


def null_safe_hash(*cols: Column) -> Column:
    """xxhash64 that tells NULL from every value."""
    return F.xxhash64(*[x for c in cols for x in (c.isNull(), c)])


# --- words and shingles over UTF-8 bytes (numpy, inside tasks) ---------------

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)        # odd, so it has an inverse modulo 2^64
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_rng = np.random.default_rng(20240607)
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)
_IS_ALNUM = np.zeros(256, bool)
_IS_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_powers: dict[str, np.ndarray] = {}


def _pow_table(base: np.uint64, n: int) -> np.ndarray:
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        out = np.full(size, base, np.uint64)
        out[0] = 1
        have = _powers[key] = np.multiply.accumulate(out)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    x = (x ^ (x >> np.uint64(32))) * _MULT
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte run ``data[starts[i]:ends[i]]`` (equal bytes, equal hash)."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    n = len(data)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * _pow_table(_BASE, n), out=acc[1:])
    h = (acc[ends] - acc[starts]) * _pow_table(_BASE_INV, n + 1)[starts]
    return mix64(h + (ends - starts).astype(np.uint64))


def words_of(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed lower-case letter-or-digit words of many texts at once.

    Returns (hashes, text index of each word, first word of each text with an
    end mark, byte span of each word as an (n, 2) array within its lower-case
    UTF-8 text).  NULL counts as the empty text.
    """
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
    base = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    ok = _IS_ALNUM[data]
    edge = np.diff(ok.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(base, starts, side="right") - 1
    first = np.searchsorted(starts, base)
    hashes = run_hashes(data, starts, ends)
    return hashes, owner, first, np.stack([starts - base[owner], ends - base[owner]], 1)


def shingle_hashes(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words; run i starts at word i."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * _BASE + words[j:j + n]
    return mix64(h)


def slices(texts: list, chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive runs of texts of about ``chars`` characters."""
    s = held = 0
    for i, t in enumerate(texts):
        held += len(t) if t else 0
        if held >= chars:
            yield s, i + 1
            s, held = i + 1, 0
    if s < len(texts):
        yield s, len(texts)


# --- connected components ----------------------------------------------------

def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of each node's component.

    Alternates large-star and small-star steps on the link table; each round is
    two grouped minima (combined on the map side) and is written to shared
    storage.  The links never reach the driver, only a count per round.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "links")
    last = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low2 = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(low2, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = materialize(small, "links")
        stat = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        stat = tuple(stat)
        if stat == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = stat


def long_type(x) -> np.ndarray:
    return np.asarray(x).astype(np.uint64).view(np.int64)


DOC_FIELDS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
