"""Operator 1: hierarchical language identification.

A text is first given to a language family (one linear support vector machine per
family against the rest), then one-versus-one linear machines vote among the
languages of that family.  Features are hashed byte 2- to 4-grams of the lower-case
letters, as square roots of their shares (unit length for every text length).

Each machine is trained in its own task on a sample of labelled rows that holds
about ``max_train_docs`` rows whatever the input size, drawn evenly over the
languages by a hash of the row; only the weight vectors (machines x 2^16 numbers)
reach the driver and are broadcast.

Nulls: a NULL text or one without letters gets ``und`` and score 0; a NULL language
or id is never learned from.  Without training rows everything is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import release

# ISO 639-1 codes by family.  A language not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "austronesian": "id jv ms tl",
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
BITS = 16
UND = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MULT = np.uint32(2654435761)


def family(lang: str) -> str:
    return FAMILY_OF.get(lang, lang)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(feature ids, values) of a text; None when it has no letter."""
    clean = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not any(map(str.isalpha, clean)):
        return None
    b = np.frombuffer(f" {clean} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    counts = np.zeros(1 << BITS, np.int64)
    gram = b[:-1] | (b[1:] << np.uint32(8))
    for n in (2, 3, 4):
        if n > 2:
            if len(b) < n:
                break
            gram = gram[:-1] | (b[n - 1:] << np.uint32(8 * (n - 1)))
        counts += np.bincount(((gram + np.uint32(n)) * _MULT) >> np.uint32(32 - BITS), minlength=1 << BITS)
    ids = np.flatnonzero(counts).astype(np.int32)
    values = np.sqrt(counts[ids] / counts[ids].sum())
    return ids, values


def train_svm(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, c: float = 10.0,
              epochs: int = 12, seed: int = 1) -> np.ndarray:
    """Linear SVM with squared hinge loss by dual coordinate descent; the last weight is the bias."""
    w = np.zeros((1 << BITS) + 1)
    alpha, rng = np.zeros(len(rows)), np.random.default_rng(seed)
    norm = [v @ v + 1.0 + 0.5 / c for _, v in rows]
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids, v = rows[i]
            grad = y[i] * (w[ids] @ v + w[-1]) - 1.0 + alpha[i] * 0.5 / c
            new = max(0.0, alpha[i] - grad / norm[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[ids] += step * v
                w[-1] += step
                alpha[i] = new
    return w


@dataclass(frozen=True)
class LanguageModel:
    families: tuple[str, ...]                       # in the order of the first machines
    languages: dict                                 # family -> its languages
    pairs: dict                                     # (a, b) -> column of its machine
    weights: np.ndarray                             # (2^BITS + 1, machines)

    def predict(self, text: str | None) -> tuple[str, float]:
        f = features(text)
        if f is None or not self.families:
            return UND, 0.0
        ids, v = f
        m = v @ self.weights[ids] + self.weights[-1]
        if len(self.families) == 1:
            fam, p_family = self.families[0], 1.0
        else:
            e = np.exp(np.clip(3.0 * m[:len(self.families)], -60, 60))
            best = int(np.argmax(e))
            fam, p_family = self.families[best], float(e[best] / e.sum())
        langs = self.languages[fam]
        if len(langs) == 1:
            return langs[0], p_family
        votes, belief = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0)
        for a, b in combinations(langs, 2):
            p = float(1.0 / (1.0 + np.exp(np.clip(-3.0 * m[self.pairs[a, b]], -60, 60))))
            votes[a if p >= 0.5 else b] += 1
            belief[a] += p / (len(langs) - 1)
            belief[b] += (1.0 - p) / (len(langs) - 1)
        lang = max(langs, key=lambda x: (votes[x], belief[x]))
        return lang, p_family * belief[lang]


def id_remainder(col: Column, n: int) -> Column:
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(n))


def fit(train: DataFrame, max_train_docs: int = 12_000) -> LanguageModel:
    """Fit on rows (text, lang); about ``max_train_docs`` of them, evenly over the languages."""
    rows = train.select("text", "lang").where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}   # one row per language
    langs = sorted(sizes)
    if not langs:
        return LanguageModel((), {}, {}, np.zeros(((1 << BITS) + 1, 0), np.float32))
    per = max_train_docs / len(langs)
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, per / sizes[k])))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(draw < share[F.col("lang")])

    by_family: dict[str, list[str]] = {}
    for x in langs:
        by_family.setdefault(family(x), []).append(x)
    families = sorted(by_family)
    machines = [("family", f, "") for f in families] if len(families) > 1 else []
    pairs = {p: 0 for f in families for p in combinations(by_family[f], 2)}
    for k, (a, b) in enumerate(pairs):
        pairs[a, b] = len(machines)
        machines.append(("pair", a, b))
    if not machines:
        return LanguageModel(tuple(families), by_family, pairs, np.zeros(((1 << BITS) + 1, 0), np.float32))
    uses = F.array(*[F.when(F.lit(True) if kind == "family" else F.col("lang").isin(a, b), F.lit(i))
                     for i, (kind, a, b) in enumerate(machines)])
    jobs = sample.select("text", "lang", F.explode(F.array_compact(uses)).alias("machine"))

    def train_one(key, pdf: pd.DataFrame) -> pd.DataFrame:
        kind, a, b = machines[key[0]]
        pdf = pdf.sort_values(["lang", "text"], kind="stable")
        feats = [features(t) for t in pdf["text"]]
        ok = [i for i, f in enumerate(feats) if f is not None]
        hit = [family(x) == a if kind == "family" else x == a for x in pdf["lang"]]
        w = train_svm([feats[i] for i in ok], np.where([hit[i] for i in ok], 1.0, -1.0))
        del feats, pdf
        release()
        return pd.DataFrame({"machine": [key[0]], "w": [w.astype(np.float32).tobytes()]})

    got = jobs.groupBy("machine").applyInPandas(train_one, "machine int, w binary").collect()
    weights = np.zeros(((1 << BITS) + 1, len(machines)), np.float32)
    for r in got:
        weights[:, r["machine"]] = np.frombuffer(r["w"], np.float32)
    return LanguageModel(tuple(families), by_family, pairs, weights)


def predictor(spark, model: LanguageModel):
    """A column function text -> struct(lang_pred, score)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        try:
            for texts in batches:
                yield pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score"])
        finally:
            release()

    return predict


def identify(df: DataFrame) -> DataFrame:
    """``df`` with a struct ``_lid`` (lang_pred, score); learns from rows outside fold 1 of 3."""
    fold = id_remainder(F.col("doc_id"), 3)
    model = fit(df.where(fold != 1))
    return df.withColumn("_lid", predictor(df.sparkSession, model)("text"))


def op1(df: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    base = df.select("doc_id", "text", "lang")
    held = F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return identify(base).select("doc_id", held.alias("held_out"), "_lid.lang_pred", "_lid.score")


def known_language(df: DataFrame) -> DataFrame:
    """The rows whose text has a predicted language; rows without letters are rejected.

    Where no language could be learned, nothing can be predicted and every row with a letter stays.
    """
    model = fit(df.select("doc_id", "text", "lang").where(id_remainder(F.col("doc_id"), 3) != 1))
    if not model.families:
        return df.where(F.col("text").rlike(r"\p{L}"))
    # the row travels as one struct, so that its columns clash with nothing
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
                     predictor(df.sparkSession, model)("text").alias("_lid"))
    return rows.where(F.col("_lid.lang_pred") != UND).select("_row.*")
