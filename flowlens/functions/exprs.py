"""Column-expression helpers (pure JVM-side expressions, no UDFs)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Constants of the portable 32-bit mixing hash (fixed values).
HASH_MULT = 2654435761
HASH_MULT_2 = 2246822519
MIX = 73244475
TWO_32 = 4294967296
MASK_32 = TWO_32 - 1


def _stream_key(seed: int, mult: int) -> int:
    """32-bit key of the stream (seed, mult); nearby seeds give unrelated keys."""
    x = (seed * HASH_MULT + mult) & MASK_32
    for _ in range(3):
        x = ((x ^ (x >> 16)) * MIX) & MASK_32
    return x ^ (x >> 16)


def hash32(id_col: Column, seed: int = 42, mult: int = HASH_MULT) -> Column:
    """Mixed 32-bit hash of an id in BIGINT arithmetic that never overflows.

    Each (seed, mult) is a stream of its own: three multiply-xor-shift rounds over
    both halves of the id make the streams of one id independent of each other.
    """
    def mixed(x: Column) -> Column:
        return (x.bitwiseXOR(F.shiftright(x, 16)) * F.lit(MIX)).bitwiseAND(F.lit(MASK_32))

    i = id_col.cast("bigint")
    x = mixed(mixed(i.bitwiseAND(F.lit(MASK_32)).bitwiseXOR(F.lit(_stream_key(seed, mult)))))
    x = mixed(x.bitwiseXOR(F.shiftright(i, 32).bitwiseAND(F.lit(MASK_32))))
    return x.bitwiseXOR(F.shiftright(x, 16))


def hash32_array(ids: np.ndarray, seed: int = 42, mult: int = HASH_MULT) -> np.ndarray:
    """:func:`hash32` of an int64 array."""
    def mixed(x):
        return ((x ^ (x >> 16)) * MIX) & MASK_32

    x = mixed(mixed((ids & MASK_32) ^ _stream_key(seed, mult)))
    x = mixed(x ^ ((ids >> 32) & MASK_32))
    return x ^ (x >> 16)


def hash32_sql(id_expr: str, seed: int = 42, mult: int = HASH_MULT) -> str:
    def mixed(x: str) -> str:
        return f"((xor({x}, ({x}) >> 16) * {MIX}) & {MASK_32})"

    i = f"CAST({id_expr} AS BIGINT)"
    x = mixed(mixed(f"xor({i} & {MASK_32}, CAST({_stream_key(seed, mult)} AS BIGINT))"))
    x = mixed(f"xor({x}, ({i} >> 32) & {MASK_32})")
    return f"xor({x}, {x} >> 16)"


def uniform(id_col: Column, seed: int = 42, mult: int = HASH_MULT) -> Column:
    """Deterministic uniform in (0, 1) from an id."""
    return (hash32(id_col, seed, mult).cast("double") + F.lit(0.5)) / F.lit(float(TWO_32))


def uniform_sql(id_expr: str, seed: int = 42, mult: int = HASH_MULT) -> str:
    return f"((({hash32_sql(id_expr, seed, mult)}) + 0.5) / {float(TWO_32)})"


def sig(x: Column, digits: int = 9) -> Column:
    """Round to ``digits + 1`` significant digits, identically in Spark and DuckDB
    (scale by an exact power of ten, round, undo)."""
    k = F.floor(F.log10(F.abs(x)))
    up = F.round(x / F.pow(F.lit(10.0), k), digits) * F.pow(F.lit(10.0), k)
    down = F.round(x * F.pow(F.lit(10.0), -k), digits) / F.pow(F.lit(10.0), -k)
    return (F.when(x.isNull() | F.isnan(x) | (x == 0) | (F.abs(x) == float("inf")), x)
            .when(k >= 0, up).otherwise(down))


def sig_sql(x: str, digits: int = 9) -> str:
    k = f"floor(log10(abs({x})))"
    return (f"(CASE WHEN ({x}) IS NULL OR isnan({x}) OR ({x}) = 0 OR abs({x}) = 'Infinity'::DOUBLE THEN ({x}) "
            f"WHEN {k} >= 0 THEN round(({x}) / power(10.0, {k}), {digits}) * power(10.0, {k}) "
            f"ELSE round(({x}) * power(10.0, -{k}), {digits}) / power(10.0, -{k}) END)")
