"""Operator 6: token ids in wavelet matrices.

Rows are dealt by ranges of (id, text hash) and written, in order, as shards of a
bounded number of tokens.  Each shard is one compressed file image, a row of a
Parquet table in the shared folder, so any store that Spark writes can hold it:

    magic "WMX1", then for each section its length and its zstd frame
    header      number of tokens, bits, documents
    doc ids     int64, and a byte each that tells NULL
    doc sizes   uint32 tokens of each document
    zeros       uint64 per bit plane
    planes      one section per bit, most significant first, bits packed little-endian

A bit plane of the matrix holds one bit of every token, the tokens being stably
parted by the bits above it.  Cumulative bit counts per 512 bits (rebuilt on
opening) answer rank in one step and select by binary search; they serve access,
counting and occurrence lookup without decoding the shard.

Nulls: a NULL text is the empty text (its only id is the end id); a NULL id sorts
first.  Repeated rows are kept.  An empty table gives no files and an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import materialize, slices

MAGIC, END_ID, BLOCK = b"WMX1", 0, 512
FILE_SCHEMA = "part int, seq int, n_docs long, n_tokens long, image binary"


class WaveletMatrix:
    """Rank/select bit planes over a token sequence."""

    def __init__(self, n: int, zeros: np.ndarray, planes: list[np.ndarray]):
        self.n, self.zeros, self.planes = n, zeros, planes      # planes: packed bits
        self.ones = []
        for p in planes:
            pad = np.zeros(-(-len(p) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
            pad[:len(p)] = p
            per = np.bitwise_count(pad.reshape(-1, BLOCK // 8)).sum(1, dtype=np.int64)
            self.ones.append(np.concatenate([[0], np.cumsum(per)]))

    @classmethod
    def build(cls, tokens: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(tokens.max()).bit_length()) if len(tokens) else 1
        x = tokens.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros = [], []
        for b in range(bits - 1, -1, -1):
            bit = (x >> b & 1).astype(bool)
            planes.append(np.packbits(bit, bitorder="little"))
            low = x[~bit]
            zeros.append(len(low))
            x = np.concatenate([low, x[bit]])
        return cls(len(tokens), np.asarray(zeros, np.uint64), planes)

    def tokens(self) -> np.ndarray:
        """The whole sequence: the partings undone from the lowest plane up."""
        bits = len(self.planes)
        value = np.zeros(self.n, np.uint32)
        for level in range(bits - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            z, up = int(self.zeros[level]), np.empty(self.n, np.uint32)
            up[~bit] = value[:z]
            up[bit] = value[z:] | np.uint32(1 << (bits - 1 - level))
            value = up
        return value

    def rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block = i // BLOCK
        part = np.unpackbits(self.planes[level][block * BLOCK // 8:-(-i // 8)], bitorder="little")
        return int(self.ones[level][block]) + int(part[:i - block * BLOCK].sum())

    def select(self, level: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) bit of that kind in a plane."""
        counts = self.ones[level] if bit else np.arange(len(self.ones[level])) * BLOCK - self.ones[level]
        block = int(np.searchsorted(counts, k, "right")) - 1
        part = np.unpackbits(self.planes[level][block * BLOCK // 8:(block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(part == bit)[k - int(counts[block])])

    def access(self, i: int) -> int:
        """Token at position ``i``."""
        token = 0
        for level in range(len(self.planes)):
            bit = int(self.planes[level][i // 8] >> (i % 8) & 1)
            ones = self.rank1(level, i)
            i = int(self.zeros[level]) + ones if bit else i - ones
            token = token << 1 | bit
        return token

    def _interval(self, token: int, start: int, stop: int) -> tuple[int, int]:
        bits = len(self.planes)
        if token >> bits:
            return 0, 0
        for level in range(bits):
            a, b = self.rank1(level, start), self.rank1(level, stop)
            if token >> (bits - 1 - level) & 1:
                start, stop = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of a token in a range of positions."""
        a, b = self._interval(token, start, self.n if stop is None else stop)
        return b - a

    def occurrences(self, token: int) -> list[int]:
        """All positions of a token, ascending, by select from the lowest plane up."""
        a, b = self._interval(token, 0, self.n)
        bits, out = len(self.planes), []
        for at in range(a, b):
            for level in range(bits - 1, -1, -1):
                one = token >> (bits - 1 - level) & 1
                at = self.select(level, one, at - int(self.zeros[level]) if one else at)
            out.append(at)
        return out


def write_image(doc_ids: list, sizes: np.ndarray, tokens: np.ndarray) -> bytes:
    m = WaveletMatrix.build(tokens)
    ids = np.asarray([0 if d is None else d for d in doc_ids], np.int64)
    null = np.asarray([d is None for d in doc_ids], np.uint8)
    head = struct.pack("<QII", m.n, len(m.planes), len(ids))
    zip_ = zstandard.ZstdCompressor(level=1)
    sections = [head, ids.tobytes() + null.tobytes(), sizes.astype(np.uint32).tobytes(), m.zeros.tobytes(),
                *[p.tobytes() for p in m.planes]]
    frames = [zip_.compress(s) for s in sections]
    return MAGIC + b"".join(struct.pack("<Q", len(f)) + f for f in frames)


def read_image(image: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    """(doc ids, tokens per document, matrix) of one shard file."""
    if image[:4] != MAGIC:
        raise ValueError("not a token shard")
    unzip, at, sections = zstandard.ZstdDecompressor(), 4, []
    while at < len(image):
        size, = struct.unpack_from("<Q", image, at)
        sections.append(unzip.decompress(image[at + 8:at + 8 + size]))
        at += 8 + size
    n, bits, docs = struct.unpack("<QII", sections[0])
    ids, null = np.frombuffer(sections[1], np.int64, docs), np.frombuffer(sections[1], np.uint8, docs, docs * 8)
    planes = [np.frombuffer(s, np.uint8) for s in sections[4:4 + bits]]
    return ([None if x else i for i, x in zip(ids.tolist(), null.tolist(), strict=True)],
            np.frombuffer(sections[2], np.uint32), WaveletMatrix(n, np.frombuffer(sections[3], np.uint64), planes))


def write_shards(df: DataFrame, tokenizer_path: str, text: str = "text", id_col: str = "doc_id",
                 shard_tokens: int = 1 << 20) -> DataFrame:
    """Encode every text, append the end id, and write the shard files; returns their table.

    Files are ordered by (part, seq); a shard closes once it holds ``shard_tokens``
    tokens, and a single longer document makes a longer shard.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from flowlens.llm.bpe import shared_encoder
        enc = shared_encoder(tokenizer_path)
        part, seq, ids, sizes, chunks, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def image():
            return pd.DataFrame({"part": [part], "seq": [seq], "n_docs": [len(ids)], "n_tokens": [held],
                                 "image": [write_image(ids, np.concatenate(sizes), np.concatenate(chunks))]})

        for pdf in batches:
            texts = pdf["text"].tolist()
            doc_ids = [None if pd.isna(d) else int(d) for d in pdf["doc_id"]]
            for s, e in slices(texts, min(2_000_000, 2 * shard_tokens)):
                tok, n = enc.encode(texts[s:e])
                stop = np.cumsum(n)
                tok = np.insert(tok, stop, END_ID)
                ids += doc_ids[s:e]
                sizes.append(n + 1)
                chunks.append(tok)
                held += len(tok)
                if held >= shard_tokens:
                    yield image()
                    seq, ids, sizes, chunks, held = seq + 1, [], [], [], 0
        if ids:
            yield image()

    return materialize(ordered.mapInPandas(encode, FILE_SCHEMA), "token-shards")


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, seq, image in zip(pdf["part"], pdf["seq"], pdf["image"], strict=True):
                ids, sizes, m = read_image(image)
                raw = m.tokens().astype("<u4").tobytes()
                stop = np.cumsum(sizes.astype(np.int64))
                view = memoryview(raw)
                crc = [zlib.crc32(view[4 * (b - n):4 * b]) for b, n in zip(stop.tolist(), sizes.tolist(), strict=True)]
                yield pd.DataFrame({"part": part, "seq": seq, "doc_id": pd.array(ids, "Int64"), "at": stop - sizes,
                                    "n_tokens": sizes.astype(np.int64), "ids_crc32": crc})

    docs = files.select("part", "seq", "image").mapInPandas(
        decode, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    per_file = files.select("part", "seq", "n_tokens")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = per_file.groupBy("part").agg(F.sum("n_tokens").alias("n"))          # one row per write task
    base = parts.select("part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n_tokens").over(before.partitionBy("part").orderBy("seq")), F.lit(0))
    offsets = per_file.select("part", "seq", inside.alias("inside")).join(base, "part")
    return docs.join(offsets, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("inside") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def count_token(files: DataFrame, token: int) -> DataFrame:
    """part, seq, n: how often each shard holds a token, by rank alone."""
    def count(batches):
        for pdf in batches:
            yield pd.DataFrame({"part": pdf["part"], "seq": pdf["seq"],
                                "n": [read_image(x)[2].count(token) for x in pdf["image"]]})
    return files.select("part", "seq", "image").mapInPandas(count, "part int, seq int, n long")


def op6(df: DataFrame, tokenizer_path: str) -> DataFrame:
    return read_documents(write_shards(df, tokenizer_path))
