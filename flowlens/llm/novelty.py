"""Operator 11: secrets by zstandard novelty against context and an identifier dictionary.

Base spans are the matches of three fixed patterns.  The method adds strings that look
like nothing the corpus or their surroundings hold: a candidate is a maximal run of 16
or more key characters that follows a sensitive word within ``REACH`` code points.  Its
marginal cost is the number of bytes that a zstandard frame of the surrounding
``AROUND`` code points grows by when the candidate is put in its place; the compressor is
primed with the identifiers that most documents hold.  A candidate that costs at least
``NOVEL`` of its own size, and ``LEAST_BYTES`` at least, is reported with kind ``novel``
unless it meets a base span.

The dictionary is filled up to ``DICT_BYTES`` with identifiers of letters and underscores,
by the number of documents of the whole corpus that hold them (a documented bound of the
method: zstandard wants a window of limited size; nothing of a text is skipped).
Secrets with a digit are never identifiers, however often a text is copied.

Spans are in code points, end exclusive, and cover the whole match.  A NULL text is
empty and has no spans; repeated rows give repeated results; an empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# ---- fixed by the query contract ---------------------------------------------
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")          # runs are maximal, so shorter ones can be passed over
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "novel")
# --------------------------------------------------------------------------------
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
SENSITIVE = re.compile(r"(?ai)password|passwd|passphrase|pwd|secret|token|api.?key|private.?key|access.?key|credential|bearer|auth")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
REACH, AROUND = 64, 256
NOVEL, LEAST_BYTES = 0.7, 12
DICT_BYTES, DICT_WORDS = 48_000, 8192
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z_]+")
LEVEL = 19
HELD = 200_000


def identifiers(df: DataFrame, size: int = DICT_BYTES) -> bytes:
    """The identifiers of most documents of df (text), the most frequent last, in ``size`` bytes at most."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = Counter()
        for pdf in batches:
            for t in pdf["text"].tolist():
                held.update(w for w in set(IDENTIFIER.findall(t or "")) if 4 <= len(w) <= 24)
                if len(held) > HELD:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held = Counter()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    found = df.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    # the best of 16 parts first, so that the driver gets no more rows when there are more partitions
    order = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(16))).orderBy(F.desc("n"), "word")
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= DICT_WORDS)
    best = found.orderBy(F.desc("n"), "word").limit(DICT_WORDS).collect()      # a bounded dictionary
    out, room = [], size
    for r in best:
        room -= len(r["word"]) + 1
        if room < 0:
            break
        out.append(r["word"])
    return "\n".join(reversed(out)).encode()


class Novelty:
    """Marginal compressed size of a string in its surroundings."""

    def __init__(self, dictionary: bytes):
        self.zip = zstandard.ZstdCompressor(level=LEVEL, dict_data=prepared(dictionary), write_content_size=False,
                                            write_checksum=False, write_dict_id=False)

    def cost(self, text: str, start: int, end: int) -> int:
        before, after = text[max(0, start - AROUND):start], text[end:end + AROUND]
        size = lambda s: len(self.zip.compress(s.encode("utf-8", "surrogatepass")))
        return size(before + text[start:end] + after) - size(before + after)


def prepared(dictionary: bytes):
    if len(dictionary) < 8:
        return None
    out = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    out.precompute_compress(level=LEVEL)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return sorted(out + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int, int]]:
    """(start, kind number, end, marginal bytes) of incompressible strings in sensitive context."""
    out, at, reached = [], 0, 0                      # reached: end of the base spans that begin before the run ends
    for m in RUN.finditer(text):
        start, end = m.span()
        while at < len(base) and base[at][0] < end:
            reached, at = max(reached, base[at][2]), at + 1
        if reached > start or not SENSITIVE.search(text, max(0, start - REACH), min(end, start + REACH)):
            continue
        cost = novelty.cost(text, start, end)
        if cost >= LEAST_BYTES and cost >= NOVEL * (end - start):
            out.append((start, 3, end, cost))
    return out


def secret_spans(df: DataFrame, dictionary: bytes | None = None) -> DataFrame:
    """doc_id and spans (kind, start, stop, cost; by start, then kind) of every row of df (doc_id, text)."""
    kind = df.schema["doc_id"].dataType
    rows = df.select(F.col("doc_id").cast("string").alias("doc_id"), "text")    # pandas has no nullable integers
    if dictionary is None:
        dictionary = identifiers(rows.select("text"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        novelty = Novelty(dictionary)
        for pdf in batches:
            found = []
            for t in pdf["text"].tolist():
                base = base_spans(t or "")
                spans = sorted([(*b, None) for b in base] + novel_spans(t or "", base, novelty), key=lambda x: x[:3])
                found.append([{"kind": KINDS[k], "start": s, "stop": e, "cost": c} for s, k, e, c in spans])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "spans": found})

    found = rows.mapInPandas(scan, "doc_id string, spans array<struct<kind:string,start:int,stop:int,cost:int>>")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def op11(df: DataFrame) -> DataFrame:
    found = secret_spans(df)

    def listed(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", number("assign"), number("access"), number("hex"),
                        F.sha2(listed(F.filter("spans", lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"), number("novel"))
