"""Texts packed into compressed chunks, a stored table that several passes can address."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from flowlens.llm.common import materialize

CHUNK_SCHEMA = "chunk long, doc_id array<long>, size array<long>, blob binary"
CHUNK_BITS = 20            # documents of a chunk are numbered below 2^20


def make_chunks(df: DataFrame, chunk_bytes: int = 12_000_000, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``df`` in chunks of about ``chunk_bytes`` UTF-8 bytes (NULL text: empty).

    The table is written to the shared folder, so a (chunk, index) pair names the
    same row in every later pass, repeated rows included.
    """
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        zip_, part, seq = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId(), 0
        ids, raw, room = [], [], 0

        def chunk():
            return pd.DataFrame({"chunk": [part << CHUNK_BITS | seq], "doc_id": [ids],
                                 "size": [list(map(len, raw))], "blob": [zip_.compress(b"".join(raw))]})

        for pdf in batches:
            for d, t in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids.append(None if pd.isna(d) else int(d))
                raw.append((t or "").encode("utf-8", "surrogatepass"))
                room += len(raw[-1])
                if room >= chunk_bytes or len(raw) >= (1 << CHUNK_BITS) - 1:
                    yield chunk()
                    ids, raw, room, seq = [], [], 0, seq + 1
        if ids:
            yield chunk()

    from pyspark.sql import functions as F
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    return materialize(rows.mapInPandas(build, CHUNK_SCHEMA), "chunks")


def open_chunk(blob: bytes, sizes) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, start of each text with an end mark)."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return data, np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))])


def runs(base: np.ndarray, limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive texts of about ``limit`` bytes: pairs of first and last + 1."""
    s, n = 0, len(base) - 1
    while s < n:
        e = max(s + 1, int(np.searchsorted(base, base[s] + limit, "right")) - 1)
        yield s, e
        s = e


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` consecutive values (block prefix and suffix minima)."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    pad = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    pad[:len(x)] = x
    grid = pad.reshape(-1, w)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])
