"""Mixing against its targets, and the draws against a plain count."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from starweave.llm import mixing
from starweave.llm.mixing import Draw, Permutation, mix_counts, mix_documents, shares

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_shares_stop_at_the_cap_and_reshare():
    assert shares([100, 100, 100]) == [200.0, pytest.approx(250 * 2 / 3), pytest.approx(250 / 3)]
    assert shares([]) == []
    assert shares([0, 10]) == [0.0, 15.0]
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.choice([0, 1, 50, 999, 10**6]) for _ in range(rng.randint(1, 12))]
        got = shares(sizes)
        assert sum(got) == pytest.approx(1.5 * sum(sizes))
        assert all(0 <= t <= 2 * s + 1e-6 for t, s in zip(got, sizes))


def test_permutation_and_its_inverse():
    for n in (1, 2, 3, 7, 64, 1000):
        order = Permutation(n, 5)
        assert sorted(order(np.arange(n)).tolist()) == list(range(n))
        assert (order.inverse(order(np.arange(n))) == np.arange(n)).all()


def test_draws_give_every_target_to_the_word():
    rng = random.Random(2)
    for seed in range(40):
        sizes = tuple(rng.choice([0, 1, 7, 8, 100, 5000]) for _ in range(5))
        wanted = tuple(rng.randint(0, 2 * s) for s in sizes)
        draw = Draw(sizes, wanted, seed, block=8, shard=16)
        rows = list(draw.counts(0, draw.n_shards))
        taken = Counter()
        for shard, before, n in rows:
            assert n.sum() == 16 or shard == draw.n_shards - 1
            for s in np.flatnonzero(n):
                for slot in range(before[s], before[s] + n[s]):
                    epoch, place = divmod(int(slot), draw.blocks(s))
                    block = int(draw.order(s, epoch)(place)[0])
                    size = min(8, sizes[s] - 8 * block)
                    last, cut = draw.slots(s)
                    taken[s] += size - (cut if slot == last - 1 else 0)
        assert [taken[s] for s in range(5)] == list(wanted)
        # A part of the shards is drawn as within the whole.
        some = list(draw.counts(1, 3))
        assert [(a, b.tolist(), c.tolist()) for a, b, c in some] == [
            (a, b.tolist(), c.tolist()) for a, b, c in rows[1:3]
        ]


@pytest.fixture
def corpus(docs):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["a", "bb", "é\n", "c\t"], k=rng.randint(0, 400)))) for i in range(120)]
    return docs(*rows, (None, None), (5, ""), (5, "twice"), (5, "twice"), (900, "w " * 20_000))


def test_counts_meet_targets(corpus):
    rows = mix_counts(corpus).collect()
    assert len(rows) == corpus.count()
    source = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        key = (r["source_size"], r["target"])
        source[key] = source.get(key, 0) + r["taken"]
    assert len(source) == 3
    for (size, target), taken in source.items():
        assert abs(taken - target) <= 1
    again = mix_counts(corpus).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, rows), key=repr)


def test_documents_hold_the_taken_words(corpus):
    counts = Counter()
    for r in mix_counts(corpus).collect():
        counts[r["doc_id"]] += r["taken"]
    texts = {(r["doc_id"], r["text"] or "") for r in corpus.collect()}
    mixed = mix_documents(corpus)
    assert mixed.schema == corpus.schema
    words = Counter()
    for r in mixed.collect():
        got = WORD.findall(r["text"])
        words[r["doc_id"]] += len(got)
        assert r["n_chars"] == len(r["text"])
        assert got
        assert any(set(got) <= set(WORD.findall(t)) for i, t in texts if i == r["doc_id"])
    assert words == Counter({i: n for i, n in counts.items() if n})


def test_empty_tables(docs):
    assert mix_counts(docs()).count() == 0
    assert mix_documents(docs()).count() == 0
    assert mix_counts(docs((1, None), (2, " "))).select("taken").distinct().collect() == [(0,)]


def test_slots_are_not_broadcast(spark, docs, scratch):
    """They grow with the corpus, while Spark takes their range for a small one."""
    from tests.conftest import plan

    made = docs(*((i, "a b c d") for i in range(50)))
    *_, pieces = mixing.mixed_pieces(made, scratch, carry=["doc_id"])
    text = plan(pieces)
    # The slots come out of their function under a sort and an exchange by hash.
    at = text.index("MapInArrow")
    above = [line for line in text[:at].splitlines() if "Join" in line or "Exchange" in line]
    assert "SortMergeJoin [s" in text and "BroadcastExchange" not in above[-1]
