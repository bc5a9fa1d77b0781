"""Operators 11, 12 and 13 against brute force, with null, empty, long and repeated rows."""

import hashlib
import random
import re
import string
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.conftest import table_of

DOC = "doc_id long, text string, lang string, n long, word string, id long"


def frame(spark, rows):
    """(doc_id, text, lang) rows with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(d, t, lang, 1, "x", 5) for d, t, lang in rows], DOC).repartition(3)


# --- 11 ------------------------------------------------------------------------

def plain_base(text):
    """The contract, read literally."""
    out = []
    assign = (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12)
    rest = [(r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), (r"[0-9a-f]+", lambda m: len(m[0]) >= 16)]
    for k, (pattern, keep) in enumerate([assign, *rest]):
        flags = re.I | re.A if k == 0 else 0
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text, flags) if keep(m)]
    return [("assign", "access", "hex")[k] + f":{s}:{e}" for s, k, e in sorted(out)]


def secret_rows():
    rng = random.Random(8)
    letters = string.ascii_letters + string.digits
    def key(n, a=letters):
        return "".join(rng.choice(a) for _ in range(n))
    prose = "the keeper of the garden wrote about the password of summer and the token of thanks "
    texts = [prose * 3, None, "", " ", "é" * 40 + ' password = "' + key(20) + '" ü', "TOKEN:'" + key(11) + "'",
             "token=secret:abcdefghijklmnop", "api_key : " + key(30) + ", APIKEY=" + key(12), "AKIA" + key(16, "ABCXYZ0123456789"),
             "AKIAKIA" + key(13, "ABC012"), "AKIA" + key(13, "ABC012"), "x" + key(40, "0123456789abcdef") + "g", key(15, "abcdef") + " " + key(16, "abcdef"),
             "Key toKen= " + key(20), "secret" + " " * 3000 + "= " + key(25),
             "Authorization: Bearer " + key(48) + "\n", "bearer thegardenthegardenthegardenthegarden and " + prose,
             "the private key is here: " + key(64, letters + "+/") + "== and more", "wandering " + key(48) + " without reason",
             "token = \"" + key(40, "0123456789abcdef") + "\"", (prose * 2000) + " secret: " + key(32) + " " + prose * 2000]
    return [(i, t, "en") for i, t in enumerate(texts)] + [(3, texts[4], "fr"), (3, texts[4], "fr"), (None, texts[7], None)]


def test_secret_scan_base_spans_and_novelty(spark):
    from flowlens.llm.novelty import op11
    rows = secret_rows()
    got = op11(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = Counter()
    for d, t, _ in rows:
        base = plain_base(t or "")
        kinds = Counter(x.split(":")[0] for x in base)
        want[d, kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(",".join(base).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got) == want
    for r in got:
        spans = [tuple(x.split(":")) for x in r["spans"].split(",") if x]
        base = [":".join(x) for x in spans if x[0] != "novel"]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r["base_sha256"]
        order = ("assign", "access", "hex", "novel")
        assert spans == sorted(spans, key=lambda x: (int(x[1]), order.index(x[0])))
    novel = {r["doc_id"]: r["n_novel"] for r in got}
    assert (novel[15], novel[17]) == (1, 1)                     # a bearer header, a private key
    assert (novel[0], novel[16], novel[18], novel[20]) == (0, 0, 0, 0)   # prose, repeats, no context, base span


def test_secret_scan_novelty_is_measured_against_the_dictionary(spark):
    from flowlens.llm.novelty import Novelty, identifiers
    name = "load_customer_invoice_table_from_archive"
    plain, primed = Novelty(b""), Novelty(("\n".join(["load_customer_invoice", "_table_from_archive"]) * 2).encode())
    text = "secret " + name + " used here"
    assert primed.cost(text, 7, 7 + len(name)) < plain.cost(text, 7, 7 + len(name)) / 2
    docs = frame(spark, [(i, f"call load_invoice now{i}zz a1b2c3d4", "en") for i in range(30)] + [(99, "lonely_word", "en")])
    words = identifiers(docs.select("text")).decode().split("\n")
    assert set(words) == {"call", "load_invoice"}
    assert identifiers(docs.where("false").select("text")) == b""


def test_secret_scan_empty(spark):
    from flowlens.llm.novelty import op11
    assert op11(spark.createDataFrame([], DOC)).collect() == []
    one = op11(frame(spark, [(1, None, None)])).collect()
    assert [tuple(r)[:4] for r in one] == [(1, 0, 0, 0)] and one[0]["spans"] == ""


# --- 12 ------------------------------------------------------------------------

def plain_collocations(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if 2 <= len(p) and a >= least}
        covered = defaultdict(int)
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    covered[p[i:i + k]] = max(covered[p[i:i + k]], a)
        found = []
        for p, a in cand.items():
            if p in covered and 100 * covered[p] >= 80 * a:
                continue
            s, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def collocation_rows():
    rng = random.Random(4)
    words = ["the", "Red", "fox", "jumps", "over", "été", "a", "|", "New", "York", "City", "x y", " q"]
    def text(n):
        return "".join(rng.choice(words) + rng.choice([" ", " ", "  ", " \t", ", ", ".", "\n", "\x0b"]) for _ in range(n))
    rows = [(i, text(rng.randint(0, 60)), rng.choice(["en", "fr", None, "und"])) for i in range(60)]
    rows += [(100 + i, "in the heart of New York City we saw rare%d things" % i, "en") for i in range(40)]
    rows += [(200, None, "en"), (201, "", None), (202, " \t\n", "de"), (203, text(4000), "en"), (204, "one", "")]
    return rows + [rows[3]] * 3 + [(None, rows[7][1], "fr")]


@pytest.mark.parametrize("least, top", [(3, 2000), (30, 7)])
def test_collocations(spark, least, top):
    from flowlens.llm.collocations import collocations
    rows = collocation_rows()
    want = plain_collocations(rows, least, top)
    assert len(want) > 5
    assert table_of(collocations(frame(spark, rows), least, top)) == sorted(want, key=lambda r: tuple((True, str(x)) for x in r))


def test_collocations_do_not_depend_on_bitmaps_or_seed(spark, monkeypatch):
    from flowlens.llm import collocations as c
    rows = collocation_rows()
    want = table_of(c.collocations(frame(spark, rows), 5, 100))
    # full bitmaps prune nothing
    monkeypatch.setattr(c, "frequent_words", lambda words, bits, least: np.full((1 << bits) // 8, 255, np.uint8))
    monkeypatch.setattr(c, "frequent_grams", lambda rows, seed, known, bits, least: [np.full((1 << bits) // 8, 255, np.uint8)] * 3)
    assert table_of(c.collocations(frame(spark, rows), 5, 100)) == want


def test_collocation_score_is_exact_beyond_64_bits(spark):
    from flowlens.llm.collocations import score
    big = 9_000_000_000_000_000_001
    counts = spark.createDataFrame([([1, 2], big), ([1], big), ([2], big + 2), ([3, 4], 30), ([3], 31), ([4], 30)], "phrase array<long>, f long")
    got = {tuple(r["phrase"]): r["score"] for r in score(counts).collect()}
    assert got == {(1, 2): int(Fraction(2_000_000 * big, 2 * big + 2)), (3, 4): 2_000_000 * 30 // 61}


def test_collocations_empty(spark):
    from flowlens.llm.collocations import op12
    assert op12(spark.createDataFrame([], DOC)).collect() == []
    assert op12(frame(spark, [(1, None, None), (2, "", "en"), (3, "a b", "en")])).collect() == []


# --- 13 ------------------------------------------------------------------------

def plain_groups(rows):
    n = Counter()
    for d, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    around = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(around[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(around[w]), None if form[w] is None else n[form[w]]))
    return out


def variant_rows():
    rng = random.Random(12)
    base = ["".join(rng.choice("abcdé") for _ in range(rng.randint(6, 12))) for _ in range(60)]
    def edited(w):
        i, kind = rng.randrange(len(w)), rng.randrange(3)
        return w[:i] + ("" if kind == 0 else rng.choice("abcxÀ")) + w[i + (kind < 2):]
    weights = [10 ** rng.uniform(0, 3) for _ in base]
    rows = []
    for d in range(120):
        ws = rng.choices(base, weights, k=60)
        ws = [edited(w) if rng.random() < .2 else w for w in ws]
        ws = [edited(w) if rng.random() < .1 else w for w in ws]
        rows.append((d, " ".join(w.upper() if rng.random() < .1 else w for w in ws) + " Straße×÷9x", "en"))
    chain = [("chainedword", 1500), ("chainedwore", 110), ("chainedzore", 9)]
    rows += [(500, ("%s " % w) * k, "en") for w, k in chain]
    return rows + [(600, None, None), (601, "", "fr"), (602, "z" * 50_000 + " " + "z" * 50_000, "fr"), (603, "z" * 49_999 + " " + "z" * 49_999, "en"),
                   (None, "chainedword nullable nullable", None)] + [rows[0]] * 3


@pytest.mark.parametrize("shard_words", [100_000, 37])
def test_spelling_groups(spark, shard_words):
    from flowlens.llm.variants import spelling_groups
    rows = variant_rows()
    want = plain_groups(rows)
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] not in (r[0], r[1]) for r in want)
    got = spelling_groups(frame(spark, rows), shard_words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_spelling_groups_empty(spark):
    from flowlens.llm.variants import op13
    assert op13(spark.createDataFrame([], DOC)).collect() == []
    assert op13(frame(spark, [(1, None, None), (2, "short words", "en")])).collect() == []


def test_index_intervals_are_those_of_the_sorted_text():
    from flowlens.llm.variants import Index
    words = ["banana", "bandana", "ananas", "anna"]
    index, text = Index(words), "|banana|bandana|ananas|anna|"
    for pattern in ("an", "|ban", "na|", "ana", "xyz", "|"):
        lo, hi = np.array([0]), np.array([index.n + 1])
        for ch in pattern:
            code = 1 if ch == "|" else int(np.searchsorted(index.alphabet, ord(ch))) + 2 if ord(ch) in index.alphabet else -1
            lo, hi = index.extend(lo, hi, np.array([code]))
        assert max(0, hi[0] - lo[0]) == sum(text.startswith(pattern, i) for i in range(len(text)))
