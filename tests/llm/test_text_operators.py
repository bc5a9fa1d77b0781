"""Operators 1, 2, 5, 6 and 10 against brute force, with null, empty, long and repeated rows."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import table_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def crc(x):
    return zlib.crc32(x.encode())


# --- 1 -------------------------------------------------------------------------

def test_language_id(docs, rows):
    from flowlens.llm.langid import op1
    got = op1(docs).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for d in (300, 301, 302, 303):
        assert (by_id[d]["lang_pred"], by_id[d]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "fr", "und") for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and crc(str(r["doc_id"])) % 3 == 1) for r in got)


def test_language_id_separates_families_and_pairs(spark):
    import random

    from flowlens.llm.langid import fit
    rng = random.Random(2)
    alphabet = {"en": "thewnd", "de": "schein", "fr": "queoua", "es": "losyan"}
    data = [("".join(rng.choice(a) + (" " if rng.random() < .2 else "") for _ in range(150)), lang)
            for lang, a in alphabet.items() for _ in range(30)]
    model = fit(spark.createDataFrame(data, "text string, lang string"))
    assert set(model.families) == {"germanic", "romance"}
    assert set(model.pairs) == {("de", "en"), ("es", "fr")}
    assert sum(model.predict(t)[0] == lang for t, lang in data) >= 0.98 * len(data)


def test_language_id_without_training_rows(spark, no_docs):
    from flowlens.llm.langid import op1
    assert op1(no_docs).collect() == []
    one = spark.createDataFrame([(1, "hello there", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in op1(one).collect()] == [("und", 0.0)]


# --- 2 -------------------------------------------------------------------------

def test_targets_are_reshared_until_none_is_above():
    from flowlens.llm.mix import targets
    t = targets({"a": 10, "b": 1000, "c": 500, None: 90})
    assert t["a"] == 20 and t[None] == 180 and sum(t.values()) == pytest.approx(1.5 * 1600)
    assert all(t[s] <= 2 * n + 1e-9 for s, n in {"a": 10, "b": 1000, "c": 500, None: 90}.items())
    assert targets({}) == {}


def test_flow_is_maximal_and_repeats_last():
    from flowlens.llm.mix import min_cost_flow
    flows = min_cost_flow([10, 10, 4], [[0], [0, 1], [1]], [15, 9])
    assert sum(f.get(0, 0) for f in flows) == 15 and sum(f.get(1, 0) for f in flows) == 9
    assert [sum(f.values()) for f in flows] == [10, 10, 4]          # everything once, nothing twice
    flows = min_cost_flow([10], [[0]], [17])
    assert flows == [{0: 17}]


def test_mix(docs, rows):
    from flowlens.llm.mix import op2
    got = op2(docs).collect()
    assert len(got) == len(rows) and table_of(op2(docs)) == table_of(op2(docs.repartition(5)))
    size = defaultdict(int)
    for _, t, _, s, *_ in rows:
        size[s] += len(words(t))
    taken = defaultdict(int)
    for r in got:
        assert r["taken"] <= 2 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        taken[r["source_size"], r["target"]] += r["taken"]
    assert sum(r["size"] for r in got) == sum(size.values())
    for (n, target), have in taken.items():
        assert n in size.values() and have <= target + 0.5 and (target == 0 or have >= 0.9 * target)


def test_mixed_corpus_repeats_rows(docs):
    from flowlens.llm.mix import mixed_corpus, op2
    passes = Counter()
    for r in op2(docs).collect():
        passes[r["doc_id"]] += r["passes"]
    out = mixed_corpus(docs)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == +passes


def test_mix_empty(no_docs):
    from flowlens.llm.mix import mixed_corpus, op2
    assert op2(no_docs).collect() == [] and mixed_corpus(no_docs).collect() == []


# --- 5 -------------------------------------------------------------------------

def brute_capacity(sizes, shards):
    """Smallest possible largest contiguous part, by dynamic programming."""
    total = [0]
    for s in sizes:
        total.append(total[-1] + s)
    best = [total[i] for i in range(len(total))]
    for _ in range(shards - 1):
        best = [min(max(best[j], total[i] - total[j]) for j in range(i + 1)) for i in range(len(total))]
    return best[-1]


def test_capacity_is_minimal():
    from flowlens.llm.shards import even_cuts, smallest_capacity
    rng = np.random.default_rng(0)
    for n, shards in ((1, 4), (7, 3), (30, 5), (30, 16)):
        sizes = [int(x) for x in rng.integers(1, 60, n)]
        sizes[n // 2] = 200
        c = smallest_capacity(sizes, shards)
        assert c == brute_capacity(sizes, shards)
        cuts = even_cuts(sizes, c, shards)
        parts = [sum(sizes[a:b]) for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]
        assert len(parts) == shards and max(parts) <= c and sum(parts) == sum(sizes)


def test_shards(docs, rows):
    from flowlens.llm.shards import op5, shard_table
    got = op5(docs).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(16))
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    expect = Counter((d, len((t or "").encode()) + 1, crc(t or "")) for d, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expect
    full = shard_table(docs).collect()
    home, sizes, load = {}, defaultdict(int), defaultdict(int)
    for r in full:
        assert home.setdefault(r["key"], r["shard"]) == r["shard"]           # equal texts stay together
        sizes[r["key"]] += r["size"]
        load[r["shard"]] += r["size"]
    assert max(load.values()) == brute_capacity([sizes[k] for k in sorted(sizes)], 16)


def test_shard_slots_in_sub_groups(docs):
    from flowlens.llm.shards import shard_table
    slots = defaultdict(list)
    for r in shard_table(docs, shards=2, rows_per_slot_group=7).collect():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_empty(no_docs):
    from flowlens.llm.shards import op5
    assert op5(no_docs).collect() == []


# --- 6 -------------------------------------------------------------------------

def test_wavelet_matrix():
    from flowlens.llm.wavelet import WaveletMatrix, read_image, write_image
    x = np.random.default_rng(0).integers(0, 70, 3000)
    ids, sizes, m = read_image(write_image([5, None], np.asarray([1000, 2000]), x))
    assert ids == [5, None] and sizes.tolist() == [1000, 2000]
    assert (m.tokens() == x).all() and all(m.access(i) == x[i] for i in range(0, 3000, 37))
    assert m.occurrences(7) == np.flatnonzero(x == 7).tolist() and m.occurrences(99) == []
    assert m.count(9, 100, 2500) == int((x[100:2500] == 9).sum()) and m.count(500) == 0
    one = WaveletMatrix.build(np.zeros(5, np.int64))
    assert one.tokens().tolist() == [0] * 5 and one.count(0) == 5


def test_encoder_equals_the_library():
    import random

    import public_tokenizers
    from flowlens.llm.bpe import Encoder
    enc = Encoder(public_tokenizers.path("byte_bpe_50k.json"), max_cached=500)
    rng = random.Random(3)
    bits = ["'s", "'ll", "'", "''", " ", "  ", "\n", "\t", "a", "Zé", "12", "½", "!?", "　", "\x85", "'LL", "d", "中文", "😀",
            "́", "\r\n", "\x1c", "don't", "<|endoftext|>", "​"]
    texts = ["", *("".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(1500))]
    ids, n = enc.encode(texts)
    for t, part in zip(texts, np.split(ids, np.cumsum(n)[:-1]), strict=True):
        assert part.tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_token_files(docs, no_docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    from flowlens.llm.wavelet import count_token, op6, read_documents, write_shards
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    enc = {t: [*tok.encode(t or "", add_special_tokens=False).ids, 0] for t in {r[1] for r in rows}}
    files = write_shards(docs, path, shard_tokens=3000)
    got = sorted(read_documents(files).collect(), key=lambda r: r["start"])
    assert files.count() > 1 and [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
        (d, len(enc[t]), zlib.crc32(np.asarray(enc[t], "<u4").tobytes())) for d, t, *_ in rows)
    assert sum(r["n"] for r in count_token(files, 0).collect()) == sum(enc[t].count(0) for _, t, *_ in rows)
    assert op6(no_docs, path).collect() == []


# --- 10 ------------------------------------------------------------------------

def test_tree_equals_sequential_weighting():
    """The batch tree gives the sequential mixture: weights from P_e and P_w of a tiny tree."""
    from flowlens.llm import ctw
    data, sizes = ctw.pack(["abracadabra abracadabra", "abra"])
    data = np.frombuffer(data, np.uint8)
    codes, _ = ctw.gram_codes(data, sizes)
    keys, n = np.unique(codes, return_counts=True)
    (uid, n0, n1, log_w), *_ = ctw.deep_tree(keys, n)
    one = ((uid >> np.uint64(8) & np.uint64(255)) << np.uint64(8) | uid & np.uint64(255)).astype(np.int64)
    u, inv = np.unique(one, return_inverse=True)
    shallow = ctw.shallow_tree(u, *(np.bincount(inv, v) for v in (n0, n1, log_w)))
    got = ctw.key_scores(keys, n, shallow)

    counts = defaultdict(lambda: [0, 0])
    nodes = lambda b: [((1 << j) | (b >> (8 - j)), b >> (7 - j) & 1) for j in range(8)]
    for c in codes.tolist():
        for node, bit in nodes(c & 255):
            for d in range(ctw.DEPTH + 1):
                counts[d, (c >> 8) & ((1 << 8 * d) - 1), node][bit] += 1

    def own(x):
        a, b = counts.get(x, [0, 0])
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(x):
        d, ctx, node = x
        if d == ctw.DEPTH:
            return own(x)
        below = sum(weighted(y) for y in list(counts) if y[0] == d + 1 and y[2] == node and y[1] & ((1 << 8 * d) - 1) == ctx)
        return np.logaddexp(own(x), below) - math.log(2)

    for key, value in list(zip(keys.tolist(), got.tolist(), strict=True))[:6]:
        total = 0.0
        for node, bit in nodes(key & 255):
            p = None
            for d in range(ctw.DEPTH, -1, -1):
                x = (d, (key >> 8) & ((1 << 8 * d) - 1), node)
                a, b = counts[x]
                kt = (b + .5) / (a + b + 1)
                w = 1.0 if p is None else math.exp(own(x) - math.log(2) - weighted(x))
                p = kt if p is None else w * kt + (1 - w) * p
            total += math.log10(p if bit else 1 - p)
        assert value == pytest.approx(total, abs=1e-6)


def test_scores(docs, no_docs, rows):
    from flowlens.llm.ctw import op10
    got = op10(docs).collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [(d, [*words((t or "").translate(lower)), None]) for d, t, *_ in rows]
    learn = [x for d, x in tokens if d is not None and crc(str(d)) % 10]
    count = Counter(w for x in learn for w in x)
    n, v = sum(count.values()), len(count)
    expect = defaultdict(list)
    for d, x in tokens:
        base = sum(math.log10((count[w] + .1) / (n + .1 * (v + 1))) for w in x)
        expect[d].append((d is not None and crc(str(d)) % 10 == 0, len(x), sum(count[w] > 0 for w in x), n, round(base, 6)))
    have = defaultdict(list)
    for r in got:
        have[r["doc_id"]].append((r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)))
        assert r["score"] < 0
    assert {k: sorted(x) for k, x in have.items()} == {k: sorted(x) for k, x in expect.items()}
    assert op10(no_docs).collect() == []


def test_scores_through_packed_lists_of_many_parts(docs, rows, monkeypatch):
    """A row per chunk and part, not per gram; the scores are those of one tree over the whole corpus."""
    from flowlens.llm import ctw
    monkeypatch.setattr(ctw, "PART_BYTES", 3000)
    chunks = ctw.make_chunks(docs, 30_000)
    lists = ctw.list_keys(chunks, 7)
    assert chunks.count() > 3 and lists.count() == 7 * chunks.count()
    data, sizes = ctw.pack([t for _, t, *_ in rows])
    codes, per = ctw.gram_codes(np.frombuffer(data, np.uint8), sizes)
    learn = np.repeat([d is not None and crc(str(d)) % 10 != 0 for d, *_ in rows], per)
    keys, inverse = np.unique(codes, return_inverse=True)
    n = np.bincount(inverse, learn).astype(np.int64)
    counts = ctw.corpus_counts(lists)
    assert sorted((r["key"], r["n"]) for r in counts.where("kind = 0").collect()) == list(zip(keys.tolist(), n.tolist(), strict=True))
    (uid, n0, n1, log_w), *_ = ctw.deep_tree(keys, n)
    u, inv = np.unique((uid >> np.uint64(8) & np.uint64(255)) << np.uint64(8) | uid & np.uint64(255), return_inverse=True)
    shallow = ctw.shallow_tree(u.astype(np.int64), *(np.bincount(inv, v) for v in (n0, n1, log_w)))
    value = ctw.key_scores(keys, n, shallow)
    score = np.add.reduceat(value[inverse], np.cumsum(per) - per)
    by = lambda x: (x[0] is not None, x)
    have = sorted(((r["doc_id"], r["score"]) for r in ctw.op10(docs).collect()), key=by)
    expect = sorted(((d, s) for (d, *_), s in zip(rows, score.tolist(), strict=True)), key=by)
    assert [d for d, _ in have] == [d for d, _ in expect]
    assert [s for _, s in have] == pytest.approx([s for _, s in expect], rel=1e-6)
