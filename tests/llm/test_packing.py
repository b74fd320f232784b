"""Packing as an exact round trip."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starweave.llm.packing import RoundRobin, pack, phases
from starweave.llm.tokens import WordEndEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


TEXTS = [
    "", "   ", "it's we'll THEY'RE o'clock 'quoted' x's", "1234 a²b ¼ ñÑ Straße ÇA", "a b\x85c d", "İx ΑΣ ſt",
    "<|endoftext|> x<|startoftext|>", "a_b--c..d !!! $$$", "中文 тест", "tab\there\x0bvt\x1cfs\x1f", "'", "áé é",
]


def test_cached_ids_are_the_tokenizers(tokenizer):
    rng = random.Random(2)
    signs = "abc ABC éÉ 12 .,' \n\t's 're <|> ² ß ñ -_ ſİ中"
    texts = TEXTS + ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(2000)]
    for limit in (10, 800_000):
        encoder = WordEndEncoder(PATH, limit=limit)
        for a in range(0, len(texts), 250):
            for body, ids in zip(texts[a : a + 250], encoder(texts[a : a + 250])):
                want = tokenizer.encode(body, add_special_tokens=False).ids
                assert np.frombuffer(ids, "<u4").tolist() == want, body


def test_every_token_once_and_in_proportion(docs, tokenizer):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["the", "Word", "été", "x1"], k=rng.randint(0, 300)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "long " * 9000)]
    made = pack(docs(*rows, sources=("a", "a", "a", None, "b")), PATH, window=256).collect()
    whole = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    source = {r[0]: ("a", "a", "a", None, "b")[k % 5] for k, r in enumerate(rows)}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in made:
        ids = np.array(whole[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert r["length"] > 0 and len(ids) == r["length"]
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(whole[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        windows[r["sequence_id"]].append((r["offset"], r["length"], source[r["doc_id"]]))
    for i, ids in whole.items():
        assert _covers(pieces[i], len(ids))
    total = Counter()
    for i, ids in whole.items():
        total[source[i]] += len(ids)
    n = sum(total.values())
    assert sorted(windows) == list(range(-(-n // 256)))
    for w, parts in windows.items():
        size = min(256, n - 256 * w)
        assert _covers([p[:2] for p in parts], size)
        share = Counter()
        for _, length, s in parts:
            share[s] += length
        assert all(abs(share[s] - size * total[s] / n) <= 3 for s in total)


def _covers(parts, size):
    at = 0
    for start, length in sorted(parts):
        if start != at:
            return False
        at += length
    return at == size


def test_deficits_carry_over_windows():
    rng = random.Random(4)
    for _ in range(60):
        totals = [rng.choice([0, 1, 3, 50, 1000, 70_000]) for _ in range(rng.randint(1, 9))]
        plan = RoundRobin([str(i) for i in range(len(totals))], [totals], 64)
        rows = [plan.served(w) for w in range(plan.windows + 1)]
        for w, (a, b) in enumerate(zip(rows, rows[1:])):
            assert all(y >= x for x, y in zip(a, b))
            assert sum(b) == min(64 * (w + 1), sum(totals))
            for x, t in zip(b, totals):
                assert abs(x - sum(b) * t / sum(totals)) < len(totals)
        if rows:
            assert rows[-1] == totals or not sum(totals)
        for q, t in enumerate(totals):
            cut = rng.randint(0, t)
            for start, n in ((0, cut), (cut, t - cut)):
                assert sum(p[1] for p in plan.pieces(q, start, n)) == n


def test_mixture_holds_until_a_queue_is_dry():
    parts = phases([100, 1000, 10], [1, 1, 0])
    assert [sum(p) for p in zip(*parts)] == [100, 1000, 10]
    assert parts[0] == [100, 100, 0]


def test_empty_table(docs):
    assert pack(docs(), PATH).count() == 0
