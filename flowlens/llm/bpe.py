"""Byte-level BPE encoding of many texts through the tokenizers library.

The library is asked once per distinct pre-token; texts are split into pre-tokens
with numpy over whole batches.  The split follows the tokenizer's own pattern
(contractions, letters, numbers, other signs, each with one leading space, and
white space), and a pre-token's ids do not depend on its neighbours, so the ids
equal those of ``Tokenizer.encode`` on the whole text.  Texts with strings of
special tokens, or with code points newer than Python's Unicode tables, go to
the library whole.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from flowlens.llm.common import mix64, _pow_table, _BASE, _BASE_INV

OTHER, LETTER, NUMBER, SPACE, MARK, UNKNOWN = range(6)
# Code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SHORT, LONG = "stmd", ("re", "ve", "ll")     # contractions after an apostrophe
_classes: np.ndarray | None = None


def char_classes() -> np.ndarray:
    global _classes
    if _classes is None:
        kind = {"L": LETTER, "N": NUMBER}
        t = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            cat = unicodedata.category(chr(c))
            t[c] = UNKNOWN if cat == "Cn" else kind.get(cat[0], OTHER)
        t[WHITE_SPACE] = SPACE
        _classes = t
    return _classes


def pretoken_starts(cp: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """True where a pre-token begins; MARK positions separate texts."""
    start = np.empty(len(cp), bool)
    start[:1] = True
    start[1:] = cls[1:] != cls[:-1]
    start |= cls == MARK
    # the last white space before a word stands alone, or joins the word if it is a blank
    word = np.flatnonzero(start[1:] & (cls[:-1] == SPACE) & (cls[1:] <= NUMBER)) + 1
    start[word - 1] = True
    start[word[cp[word - 1] == 32]] = False
    # contractions: an apostrophe that begins a pre-token, followed by s t m d re ve ll
    at = np.flatnonzero((cp == 39) & start)
    at = at[at + 1 < len(cp)]
    if len(at):
        nxt = cp[at + 1]
        one = np.isin(nxt, [ord(c) for c in SHORT])
        after = cp[np.minimum(at + 2, len(cp) - 1)]
        two = np.zeros(len(at), bool)
        for a, b in LONG:
            two |= (nxt == ord(a)) & (after == ord(b)) & (at + 2 < len(cp))
        for i, size in ((at[one], 2), (at[two & ~one], 3)):
            start[i + 1] = False
            rest = i + size
            start[rest[rest < len(cp)]] = True
    return start


class Encoder:
    """Whole-text ids of many texts; keeps the ids of pre-tokens it has seen."""

    def __init__(self, path: str, max_cached: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.max_cached = max_cached
        self._reset()

    def _reset(self):
        self.keys = np.zeros(0, np.uint64)                  # sorted
        self.offset, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        """Add the ids of new pre-tokens; each is handed over as a word of its own."""
        step = 64
        groups = [pieces[i:i + step] for i in range(0, len(pieces), step)]
        lengths, ids = [], []
        for words, e in zip(groups, self.tokenizer.encode_batch(
                groups, is_pretokenized=True, add_special_tokens=False), strict=True):
            owner = e.word_ids
            if None in owner:       # an added token among the words
                single = [x.ids for x in self.tokenizer.encode_batch(words, add_special_tokens=False)]
                ids.append(np.asarray([i for x in single for i in x], np.uint32))
                lengths.append(np.fromiter(map(len, single), np.int64, len(words)))
                continue
            ids.append(np.asarray(e.ids, np.uint32))
            lengths.append(np.bincount(np.asarray(owner, np.int64), minlength=len(words)))
        ids, length = np.concatenate(ids), np.concatenate(lengths)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(ids)] = ids
        offset = self.used + np.cumsum(length) - length
        self.used += len(ids)
        both = np.concatenate([self.keys, keys])
        by = np.argsort(both, kind="stable")                # two sorted runs
        self.keys = both[by]
        self.offset = np.concatenate([self.offset, offset])[by]
        self.length = np.concatenate([self.length, length])[by]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text)."""
        n = len(texts)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        joined = "\n".join(texts) + "\n"
        cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        cls = char_classes()[cp]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, n) + 1) - 1
        cls[ends] = MARK
        start = pretoken_starts(cp, cls)
        begin = np.flatnonzero(start)
        end = np.append(begin[1:], len(cp))
        real = cls[begin] != MARK
        begin, end = begin[real], end[real]
        acc = np.zeros(len(cp) + 1, np.uint64)
        value = mix64(cp.astype(np.uint64) + np.uint64(0x1234567))
        np.cumsum(value * _pow_table(_BASE, len(cp)), out=acc[1:])
        key = mix64((acc[end] - acc[begin]) * _pow_table(_BASE_INV, len(cp) + 1)[begin] + (end - begin).astype(np.uint64))
        uniq, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) + len(uniq) > self.max_cached:
            self._reset()
        at = np.searchsorted(self.keys, uniq)
        new = np.flatnonzero((at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != uniq)
                             if len(self.keys) else np.ones(len(uniq), bool))
        if len(new):
            b, e = begin[first[new]].tolist(), end[first[new]].tolist()
            self._learn(uniq[new], [joined[i:j] for i, j in zip(b, e, strict=True)])
            at = np.searchsorted(self.keys, uniq)
        slot = at[inverse]
        length = self.length[slot]
        stop = np.cumsum(length)
        ids = self.pool[np.repeat(self.offset[slot] - (stop - length), length) + np.arange(stop[-1] if len(stop) else 0)]
        total = np.concatenate([[0], stop])
        per_text = np.diff(total[np.searchsorted(begin, ends, "left")], prepend=0)
        bad = {i for i in np.unique(np.searchsorted(ends, np.flatnonzero(cls == UNKNOWN))).tolist()}
        for mark in self.special:
            if mark in joined:
                bad |= {i for i, t in enumerate(texts) if mark in t}
        if bad:
            parts = np.split(ids, np.cumsum(per_text)[:-1])
            for i in bad:
                parts[i] = np.asarray(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
            per_text = np.fromiter(map(len, parts), np.int64, n)
            ids = np.concatenate(parts)
        return ids, per_text


_encoders: dict[str, Encoder] = {}


def shared_encoder(path: str) -> Encoder:
    """One encoder per worker process and tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
