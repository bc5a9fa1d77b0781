"""Operators 3, 4, 7, 8 and 9, the pipeline, and helpers, against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest


def components_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def test_components(spark):
    from flowlens.llm.common import components
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2))] + [(i, i + 1) for i in range(70, 95)]
    want = components_of(100, links)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(i, i) == want[i] for i in range(100))
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- 3 -------------------------------------------------------------------------

def brute_cut(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        cover = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                cover[i:i + length] = True
        keep = bytes(x for x, c in zip(b, cover, strict=False) if not c)
        spans = int((np.diff(cover.astype(int), prepend=0) == 1).sum())
        out.append((len(b), int(cover.sum()), spans, hashlib.sha256(keep).hexdigest()))
    return out


@pytest.mark.parametrize("block", [6000, 3])
def test_substring_dedup(docs, no_docs, rows, monkeypatch, block):
    from flowlens.llm import pfp
    monkeypatch.setattr(pfp, "BLOCK", block)
    got = pfp.op3(docs).collect()
    want = brute_cut([r[1] for r in rows])
    assert Counter(tuple(r) for r in got) == Counter((r[0], *w) for r, w in zip(rows, want, strict=True))
    assert pfp.op3(no_docs).collect() == []


def test_shared_offsets_against_hashing():
    from flowlens.llm.pfp import shared_offsets
    rng = np.random.default_rng(3)
    length, gram, top = 20, 6, 14
    left = [bytes(rng.integers(0, 2, top, np.uint8)) for _ in range(30)]
    right = [bytes(rng.integers(0, 2, length, np.uint8)) for _ in range(30)]
    keys = rng.integers(0, 2, 30)
    spans = shared_offsets(keys, left, right, np.zeros(30, int), np.full(30, top), length, gram)
    for i in range(30):
        have = {o for a, b in spans[i] for o in range(a, b + 1)}
        want = {o for o in range(top + 1) if any(j != i and keys[i] == keys[j] and left[i][:o] == left[j][:o] and
                                                 right[i][:length - o] == right[j][:length - o] for j in range(30))}
        assert have == want


# --- 4 -------------------------------------------------------------------------

def weighted_classes(rows):
    from flowlens.llm import neardup as nd
    from flowlens.llm.common import words_of
    texts = [r[1] for r in rows]
    seen = np.zeros(1 << nd.DF_BITS)
    for t in texts:
        seen[np.unique((words_of([t])[0] >> np.uint64(64 - nd.DF_BITS)).astype(int))] += 1
    idf = np.log1p(len(texts) / np.maximum(seen, 1.0))
    sets = nd.text_sets(texts, idf)
    links = [(i, j) for i in range(len(rows)) for j in range(i) if texts[i] is not None and texts[j] is not None and
             (texts[i] == texts[j] or (len(sets[i][0]) and len(sets[j][0]) and nd.similarity(sets[i], sets[j]) >= 0.8))]
    return components_of(len(rows), links)


@pytest.mark.parametrize("block", [1000, 2])
def test_near_duplicates(docs, no_docs, rows, monkeypatch, block):
    from flowlens.llm import neardup as nd
    monkeypatch.setattr(nd, "BLOCK", block)
    root = weighted_classes(rows)
    members = defaultdict(list)
    for r, c in zip(rows, root, strict=True):
        members[c].append(r[0])
    head = {c: min((d for d in v if d is not None), default=None) for c, v in members.items()}
    want = Counter((r[0], head[c] if r[1] is not None else r[0], len(members[c]) if r[1] is not None else 1)
                   for r, c in zip(rows, root, strict=True))
    got = nd.op4(docs).collect()
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in got) == want
    if block == 1000:
        assert nd.op4(no_docs).collect() == []
        kept = nd.deduplicated(docs)
        assert kept.columns == docs.columns
        assert kept.where("text is not null").count() == len({c for r, c in zip(rows, root, strict=True) if r[1] is not None})


def test_buckets_without_a_common_centre(spark):
    """A chain a-b-c whose ends are not alike is still one class."""
    import random

    from flowlens.llm.neardup import op4
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    shift = [" ".join(words[i * 10:i * 10 + 200]) for i in range(8)]      # neighbours share 190 of 200 words
    got = op4(spark.createDataFrame([(i, t) for i, t in enumerate(reversed(shift))], "doc_id long, text string")).collect()
    assert {r["class_id"] for r in got} == {0} and {r["class_size"] for r in got} == {8}


def test_sampling_agrees_with_similarity():
    from flowlens.llm import neardup as nd
    rng = np.random.default_rng(0)
    s = np.sort(rng.integers(1, 2**63, 400).astype(np.uint64))
    w = rng.uniform(1, 9, 400)
    agree = []
    for _ in range(12):
        keep = rng.random(400) < 0.85
        agree.append(((nd.sample(s, w) == nd.sample(s[keep], w[keep])).mean(), w[keep].sum() / w.sum()))
        s = nd.mix64(s)
        s.sort()
    assert abs(np.mean([a - b for a, b in agree])) < 0.05


# --- 7 -------------------------------------------------------------------------

def test_decontamination(spark, docs, no_docs, rows):
    import duckdb
    import pyarrow as pa

    from flowlens.llm.decontam import ORACLE, clean_documents, op7
    texts = {r[0]: r[1] for r in rows}
    long = texts[305].split()
    items = [(1, " ".join(texts[3].split()[20:45])), (2, " ".join(long[4000:4060])), (3, "too few words"), (4, None), (5, ""),
             (None, " ".join(texts[7].split()[:30])), (6, " ".join([*texts[9].split()[:27], "x", "y", "z"])),
             (7, "never seen anywhere in any of these documents at all"), (1, " ".join(texts[3].split()[20:45]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter(tuple(r) for r in op7(docs, bench).collect())
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}))
    con.register("benchmark", pa.table({"item_id": pa.array([i for i, _ in items], pa.int64()), "text": pa.array([t for _, t in items], pa.string())}))
    want = Counter(con.sql(ORACLE).fetchall())
    assert got == want and len(want) >= 5
    bad = {r[0] for r in want}
    clean = clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(r[0] for r in rows if r[0] not in bad)
    assert op7(no_docs, bench).collect() == [] and op7(docs, bench.where("false")).collect() == []


def test_decontamination_of_short_and_mixed_items(spark):
    """Every exact copy is found: items of one to eight shingles, and longer ones beside an item of one shingle."""
    from flowlens.llm.decontam import op7
    docs, items, want = [], [], set()
    for n in range(300):
        w = [f"w{n}x{i}" for i in range(200)]
        docs.append((n, " ".join(w)))
        size = (5, 6, 7, 9, 12, 24)[n % 6]
        items.append((n, " ".join(w[70 + n % 32:70 + n % 32 + size])))
        want.add((n, n, size - 4, size - 4, 1.0))
    got = op7(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in got.collect()} == want


def test_prefixes_of_the_hash_functions_cover_the_range():
    from flowlens.llm.decontam import flips
    for n in (7, 50, 128):
        lead = [(f & ((1 << 64) - 1)) / 2**64 for f in flips(n)]
        assert len(set(lead)) == n
        for b in (4, 8, 16, 32):
            assert b > n or {int(x * b) for x in lead[:b]} == set(range(b))


# --- 8 -------------------------------------------------------------------------

def test_compact_windows():
    from flowlens.llm.passages import compact_windows
    rng = np.random.default_rng(1)
    for _ in range(20):
        h = rng.integers(0, 40, 150).astype(np.uint64) * np.uint64(1 << 40)
        want = set()
        for c in np.flatnonzero(h):
            a = b = int(c)
            while a > 0 and h[a - 1] > h[c]:
                a -= 1
            while b < 149 and h[b + 1] >= h[c]:
                b += 1
            if b - a >= 4:
                want.add((a, int(c), b))
        assert set(zip(*(x.tolist() for x in compact_windows(h, 5)), strict=True)) == want


def test_near_passages(docs, no_docs, rows):
    from flowlens.llm.passages import MIN_TOKENS, near_passages, tokens_of
    got = near_passages(docs).collect()
    tokens, base = tokens_of([r[1] for r in rows])
    holders = defaultdict(set)
    for i in range(len(rows)):
        s = tokens[base[i]:base[i + 1]]
        for j in range(len(s) - MIN_TOKENS + 1):
            holders[s[j:j + MIN_TOKENS].tobytes()].add(i)
    shared = {rows[i][0] for v in holders.values() if len(v) > 1 for i in v}
    found = {r["doc_id"] for r in got} | {r["match_doc_id"] for r in got}
    assert shared == found
    assert all(r["similarity"] >= 0.8 and r["n_words"] >= 50 for r in got)
    assert near_passages(no_docs).collect() == []


def stretch_by_force(a, b):
    """Tokens of the longest stretch, from match to match, in which two equally long sequences of distinct tokens reach 0.8."""
    same, best = a == b, 0
    at = np.flatnonzero(same)
    for i in at:
        for j in at[at >= i + max(45, best)] + 1:
            both = int(same[i:j].sum())
            if both >= 0.8 * (2 * (j - i) - both):
                best = int(j - i)
    return best


@pytest.mark.parametrize("where,words", [((48,), 91), ((64,), 107)])
def test_passage_with_a_replaced_word(where, words):
    from flowlens.llm.passages import tokens_of, verify
    w = [f"w{i}" for i in range(words)]
    v = [f"x{i}" if i in where else x for i, x in enumerate(w)]
    (a, _), (b, _) = tokens_of([" ".join(w)]), tokens_of([" ".join(v)])
    (found,) = verify(a, b)
    assert found[:4] == (0, words - 4, 0, words - 4) and found[4] > 0.88


def test_passages_with_edits_against_brute_force():
    from flowlens.llm.passages import tokens_of, verify
    rng = np.random.default_rng(12)
    for n in range(90):
        words, edits = int(rng.integers(50, 121)), n % 3 + 1
        w = [f"w{n}x{i}" for i in range(words)]
        v = list(w)
        for i in rng.choice(words, edits, replace=False):
            v[i] = f"edit{i}"
        pad = [[f"p{n}x{k}x{i}" for i in range(25)] for k in range(4)]
        a, b = (tokens_of([" ".join([*p, *t, *q])])[0] for p, t, q in ((pad[0], w, pad[1]), (pad[2], v, pad[3])))
        got = verify(a, b)
        assert all(j >= 0.8 and e - s >= 46 for s, e, _, _, j in got)
        assert max((e - s for s, e, *_ in got), default=0) == stretch_by_force(a, b)
    w = [f"w{i}" for i in range(120)]
    v = w[:60] + ["one", "two", "three"] + w[60:]                             # words put in
    (a, _), (b, _) = tokens_of([" ".join(w)]), tokens_of([" ".join(v)])
    assert [f[:4] for f in verify(a, b)] == [(0, 116, 0, 119)] and [f[:4] for f in verify(b, a)] == [(0, 119, 0, 116)]


@pytest.mark.parametrize("block", [300, 2])
def test_passages_whose_pieces_occur_in_earlier_documents(spark, monkeypatch, block):
    """60-word passages shared by two documents; overlapping 20-word pieces of them lie in six earlier ones."""
    from flowlens.llm import passages as ps
    monkeypatch.setattr(ps, "BLOCK", block, raising=False)
    early, late = [], []
    for n in range(25):
        w = [f"w{n}x{i}" for i in range(60)]
        for k in range(6):
            early.append(" ".join([*[f"e{n}x{k}x{i}" for i in range(60)], *w[8 * k:8 * k + 20], *[f"f{n}x{k}x{i}" for i in range(60)]]))
        for k in range(2):
            late.append(" ".join([*[f"l{n}x{k}x{i}" for i in range(40)], *w, *[f"m{n}x{k}x{i}" for i in range(40)]]))
    docs = spark.createDataFrame(list(enumerate(early + late)), "doc_id long, text string").coalesce(1)
    got = ps.near_passages(docs).collect()
    pairs = {frozenset((r["doc_id"], r["match_doc_id"])) for r in got}
    want = {frozenset((len(early) + 2 * n, len(early) + 2 * n + 1)) for n in range(25)}
    assert pairs <= want and len(got) == len(pairs)
    assert len(pairs) >= 20                                    # two of four functions must agree in 46 or more tokens


def test_leftover_pairs_of_documents_are_asked_once(spark, monkeypatch):
    """Keys by the hundred ask for the same pairs of a group of documents; each stretch is verified once, no link is lost."""
    from flowlens.llm import passages as ps
    lines, asked = [], []
    for k in range(4):                                      # earlier documents that hold pieces of the long passage
        lines.append(" ".join([*[f"e{k}x{i}" for i in range(60)], *[f"w{i}" for i in range(90 * k, 90 * k + 30)], *[f"f{k}x{i}" for i in range(60)]]))
    for k in range(6):
        lines.append(" ".join([*[f"l{k}x{i}" for i in range(40)], *[f"w{i}" for i in range(400)], *[f"m{k}x{i}" for i in range(40)]]))
    lines.append(" ".join(["again"] * 4000))                # a repeated word is one window of each stretch of REACH tokens
    lines.append(" ".join(["again"] * 4000))
    fetched = ps.fetched
    monkeypatch.setattr(ps, "fetched", lambda chunks, sides: fetched(chunks, (asked.append(sides.select("doc", "other", "s", "e", "os", "oe", "side")), sides)[1]))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").coalesce(1)
    got = ps.near_passages(docs).collect()
    root = components_of(len(lines), [(r["doc_id"], r["match_doc_id"]) for r in got])
    assert len(set(root[4:10])) == 1 and root[10] == root[11] and len({*root[:4], root[4], root[10]}) == 6
    rows = [tuple(r) for a in asked for r in a.where("side = 0 and doc <> other").collect()]
    assert len(rows) == len(set(rows))
    windows = ps.list_windows(ps.make_chunks(docs.where("doc_id = 10"))).groupBy("fn").count().collect()
    assert windows and max(r["count"] for r in windows) <= -(-4000 // ps.REACH)


# --- 9 -------------------------------------------------------------------------

def test_nearest_neighbours(spark):
    from flowlens.llm.ann import nearest
    rng = np.random.default_rng(4)
    v = rng.standard_normal((900, 16)) * rng.uniform(.2, 3, (900, 1))
    v[40] = v[41] = v[42]                                                  # ties
    data = [(i, x.tolist(), 1) for i, x in enumerate(v)]
    data += [(2000, None, 0), (2020, [0.0] * 16, 0), (2040, [1.0] * 15 + [float("nan")], 0), (2060, [float("inf")] * 16, 0),
             (2080, [1.0, 2.0], 0), (None, [1.0] * 16, 0), (2100, [], 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, rank int")
    got = defaultdict(list)
    for r in nearest(df, k=10, block_rows=200, query_rows=20).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 900, 20))
    right = 0
    for q, rows_ in got.items():
        score = v @ v[q]
        score[q] = -np.inf
        order = np.lexsort((np.arange(900), -score))[:10]
        rows_.sort()
        assert [r for r, *_ in rows_] == list(range(1, 11))
        assert all(s == pytest.approx(score[i], rel=1e-12) for _, i, s in rows_)
        assert all((-a[2], a[1]) < (-b[2], b[1]) for a, b in zip(rows_, rows_[1:], strict=False))
        right += len({i for _, i, _ in rows_} & set(order.tolist()))
    assert right >= 0.9 * 10 * len(got)
    few = spark.createDataFrame(data[:3], "vec_id long, embedding array<double>, rank int")
    assert [(r["query_id"], r["rank"]) for r in nearest(few).collect()] == [(0, 1), (0, 2)]
    assert nearest(df.where("false")).collect() == []


# --- pipeline -------------------------------------------------------------------

def test_pipeline(spark, tmp_path, docs, rows):
    import corpus_pipeline as cp
    from pyspark.sql import functions as F
    plain = docs.drop("size", "shard")
    plain.write.parquet(str(tmp_path / "documents.parquet"))
    item = " ".join(next(r[1] for r in rows if r[0] == 14).split()[5:40])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in cp.STAGES] == ["language", "near_dedup", "decontaminate", "mix", "shard"]
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, now, str(tmp_path))
        if k < 4:
            assert out.columns == plain.columns
        out.write.parquet(str(tmp_path / f"s{k}"))
        now = spark.read.parquet(str(tmp_path / f"s{k}"))
        kept[name] = Counter(r["doc_id"] for r in now.select("doc_id").collect())
    rejected = {300, 301, 302, 303}
    assert set(kept["language"]) == {r[0] for r in rows} - rejected
    assert max(kept["near_dedup"].values()) == 1 and not {100, 106, 308} & set(kept["near_dedup"])
    assert set(kept["near_dedup"]) - set(kept["decontaminate"]) == {14}
    assert set(kept["mix"]) <= set(kept["decontaminate"]) and max(kept["mix"].values()) <= 2
    assert sum(kept["shard"].values()) == sum(kept["mix"].values())
    empty = now.where(F.lit(False))
    assert empty.count() == 0
    assert cp.run(spark, str(tmp_path)).count() == sum(kept["mix"].values())
