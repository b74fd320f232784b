"""Token ids of whole texts with a cache of pieces, for files of public tokenizers."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from itertools import repeat

import numpy as np
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from starweave.llm import text

#: Code points below this are handled by the cached way; a text with others is not.
LATIN = 0x250

_KIND = np.array([{"L": 1, "N": 2, "Z": 0}.get(unicodedata.category(chr(c))[0], 3) for c in range(LATIN)])
_KIND[[9, 10, 11, 12, 13, 0x85]] = 0

#: Control characters that count as white space in some libraries only.
_ODD = np.array([0x1C <= c <= 0x1F for c in range(LATIN)] + [True])
#: Contractions are pieces of their own.
CONTRACTION = re.compile(r"'(?:[sStTmMdD]|[rR][eE]|[vV][eE]|[lL][lL])")


def special(body: str) -> bool:
    """Whether a text may have a contraction or a special token."""
    return "<|" in body or ("'" in body and CONTRACTION.search(body) is not None)


_LETTER = text.seeded(LATIN + 1, 41)
_BASE = np.uint64(text.seeded(1, 42)[0] | np.uint64(1))


class WordEndEncoder:
    """Ids of a lower-casing BPE whose pieces end in a word-end mark (``</w>``).

    Such a vocabulary cuts a text into runs of letters, single digits and runs of other
    signs and encodes each of them alone. So the ids of a text are those of its pieces, and
    a piece needs encoding once as long as the cache holds it, by a 64-bit hash. The cache
    is emptied when full; that changes the speed only.
    """

    def __init__(self, path: str, limit: int = 800_000):
        self.tokenizer = Tokenizer.from_file(path)
        # The same vocabulary for pieces that are cut and in lower case already.
        self.pieces = Tokenizer.from_file(path)
        self.pieces.normalizer = normalizers.Sequence([])
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), byte_level])
        self.limit = limit
        self.forget()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")

    def whole(self, body: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([body], add_special_tokens=False)[0].ids
        return np.array(ids, "<u4").tobytes()

    def forget(self) -> None:
        self.index: dict[int, int] = {}
        self.pool = np.empty(1 << 16, "<u4")
        self.ends_at = np.zeros(1 << 14, np.int64)  # of piece i - 1, in the pool

    def learn(self, keys: list[int], pieces: list[str]) -> None:
        """Put the ids of new pieces at the end of the pool."""
        ids = np.array(self.pieces.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(pieces):  # a piece without an end mark: one by one
            parts = [np.frombuffer(self.whole(p), "<u4") for p in pieces]
            ids, cuts = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        known = len(self.index)
        used = int(self.ends_at[known])
        while used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.empty_like(self.pool)))
        while known + len(keys) >= len(self.ends_at):
            self.ends_at = np.concatenate((self.ends_at, np.empty_like(self.ends_at)))
        self.pool[used : used + len(ids)] = ids
        self.ends_at[known + 1 : known + len(keys) + 1] = used + cuts
        self.index.update(zip(keys, range(known, known + len(keys))))

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers.

        The library itself encodes texts with contractions, possible special tokens, odd
        control characters or letters beyond Latin.
        """
        odd, out = self.cached([t.lower() for t in texts])
        return [self.whole(t) if o or special(t) else ids for t, o, ids in zip(texts, odd, out)]

    def cached(self, lower: list[str]) -> tuple[list[bool], list[bytes]]:
        """Of texts in lower case: whether their characters rule this way out, and ids."""
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in lower]))).astype(np.int64)
        joined = "".join(lower)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        odd = np.diff(np.concatenate(([0], np.cumsum(_ODD[np.minimum(codes, LATIN)])))[bounds]) > 0
        kind = _KIND[np.minimum(codes, LATIN - 1)]
        begins = np.ones(len(codes), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        begins[bounds[:-1][bounds[:-1] < len(codes)]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(codes))
        real = kind[start] != 0
        start, end = start[real], end[real]
        if not len(start):
            return odd.tolist(), [b""] * len(lower)
        size = (end - start).astype(np.int32)
        total = np.concatenate(([0], np.cumsum(size, dtype=np.int32)))
        inside = np.arange(total[-1], dtype=np.int32) - np.repeat(total[:-1], size)
        used = codes if len(codes) == total[-1] else codes[kind != 0]
        power = np.full(int(size.max()), _BASE)
        power[0] = 1
        with np.errstate(over="ignore"):
            power = np.multiply.accumulate(power)
            value = _LETTER[np.minimum(used, LATIN)] * power[inside]
            key = text.mix(np.add.reduceat(value, total[:-1]) + size.astype(np.uint64))
        key, sample, which = np.unique(key, return_index=True, return_inverse=True)
        keys = key.tolist()
        found = np.fromiter(map(self.index.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(found < 0)
        if len(self.index) + len(new) > self.limit:
            self.forget()
            new = np.arange(len(keys))
        if len(new):
            at, till = start[sample[new]].tolist(), end[sample[new]].tolist()
            found[new] = np.arange(len(self.index), len(self.index) + len(new))
            self.learn(key[new].tolist(), [joined[a:b] for a, b in zip(at, till)])
        first = self.ends_at[found]
        n = self.ends_at[found + 1] - first
        count = n[which]
        done = np.concatenate(([0], np.cumsum(count)))
        ids = self.pool[np.arange(done[-1]) + np.repeat(first[which] - done[:-1], count)].tobytes()
        cuts = (4 * done[np.searchsorted(start, bounds)]).tolist()
        return odd.tolist(), [ids[a:b] for a, b in zip(cuts, cuts[1:])]


_ENCODERS: dict[str, WordEndEncoder] = {}


def word_end_encoder(path: str) -> WordEndEncoder:
    """One encoder per Python worker, so that its cache serves all its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEndEncoder(path)
    return _ENCODERS[path]
