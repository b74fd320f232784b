"""Language profiles against plain Python, and held-out accuracy."""

from __future__ import annotations

import random
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from starweave.llm import language
from starweave.llm.queries import LLM_QUERIES


def counted(body):
    words = "".join(
        c if c.isalpha() or unicodedata.category(c)[0] == "M" else " " for c in body.casefold()
    ).split()
    grams = Counter()
    for word in words:
        padded = f"_{word}_"
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                grams[gram] += gram != "_"
    return +grams


def ranked(grams):
    key = lambda g: sum((1 if c == "_" else ord(c)) << (21 * i) for i, c in enumerate(g))
    return sorted(grams, key=lambda g: (-grams[g], key(g)))[: language.PROFILE]


def predicted(body, profiles):
    """The language with the lowest out-of-place distance, and 1 less its share of the largest."""
    if not profiles or not any(c.isalpha() for c in body):
        return "und", 0.0
    mine = ranked(counted(body))
    far = {
        lang: sum(abs(ranks[g] - i) if g in ranks else language.PROFILE for i, g in enumerate(mine))
        for lang, ranks in profiles.items()
    }
    best = min(far, key=lambda lang: (far[lang], lang))
    return best, 1 - far[best] / (language.PROFILE * len(mine))


def brute(rows):
    """(predicted, score) of each text, learned from all rows with a language and a text."""
    total = defaultdict(Counter)
    for lang, body in rows:
        if lang is not None and body is not None:
            total[lang].update(counted(body))
    profiles = {lang: {g: i for i, g in enumerate(ranked(c))} for lang, c in total.items() if c}
    return [predicted(body or "", profiles) for _, body in rows]


def test_grams_of_texts_in_slices(monkeypatch):
    rng = random.Random(1)
    for _ in range(200):
        body = "".join(rng.choice("abÉß \n.1é́") for _ in range(rng.choice([0, 1, 2, 5, 40])))
        monkeypatch.setattr(language, "SLICE", rng.choice([1, 2, 3, 7, 1000]))
        found = {language.gram_text(int(k)): int(n) for k, n in zip(*language.grams(body))}
        assert found == dict(counted(body))


@pytest.fixture
def some():
    rng = random.Random(2)
    words = {"x": ["le", "çeau", "que", "é"], "y": ["the", "thing", "of", "a"], "Z": ["дом", "мир", "и"]}
    rows = []
    for lang, its in words.items():
        rows += [(lang, " ".join(rng.choices(its, k=rng.randint(1, 30)))) for _ in range(15)]
    rows += [(None, "the thing"), ("x", None), (None, None), ("y", ""), ("q", "123 !"), ("x", "the of thing " * 20)]
    return [*rows, *rows[:20]]


def test_all_rows_against_plain_python(spark, some):
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(some)], "doc_id long, lang string, text string")
    profiles = language.learn(docs.repartition(6))
    assert profiles.languages == ["Z", "x", "y"]
    rows = language.identify(docs, profiles).select("_row.doc_id", "lang_pred", "score").orderBy("doc_id").collect()
    want = brute(some)
    assert [r["lang_pred"] for r in rows] == [w[0] for w in want]
    assert np.allclose([r["score"] for r in rows], [w[1] for w in want], atol=1e-12)


def test_counts_do_not_depend_on_how_tasks_pass_them_on(spark, some, monkeypatch):
    docs = spark.createDataFrame(some, "lang string, text string")
    once = {tuple(r) for r in language.gram_counts(docs.coalesce(1)).collect()}
    assert once == {tuple(r) for r in language.gram_counts(docs.repartition(9)).collect()}


def test_nothing_learned_empty_and_clashing_columns(spark):
    schema = "doc_id long, lang string, text string, score int, lang_pred string, gram long"
    docs = spark.createDataFrame([(1, None, "the", 5, "a", 1), (None, None, None, None, None, None)], schema)
    rows = language.identify(docs, language.learn(docs)).collect()
    assert [(r["lang_pred"], r["score"], r["_row"]["score"]) for r in rows] == [("und", 0.0, 5), ("und", 0.0, None)]
    none = docs.limit(0)
    assert language.identify(none, language.learn(none)).collect() == []


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    docs = spark.createDataFrame([(c, "a b") for c in "abc"], "lang string, text string")
    with pytest.raises(ValueError, match="languages"):
        language.learn(docs)


def test_a_long_text_is_read_whole(spark):
    """What decides stands after a megabyte of other text."""
    learned = spark.createDataFrame([("x", "le çeau que " * 50), ("y", "the thing of " * 50)], "lang string, text string")
    profiles = language.learn(learned)
    body = "the thing " * 1000 + "1 " * 600_000 + "le çeau que " * 20_000
    assert profiles.predict(body)[0] == "x"


def test_query_against_plain_python_and_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text").orderBy("doc_id").collect()
    held = [zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in docs]
    rows = LLM_QUERIES["op12_language"](spark, folder).orderBy("doc_id").collect()
    assert [r["held_out"] for r in rows] == held
    want = brute([(None if h else r["lang"], r["text"]) for r, h in zip(docs, held)])
    assert [r["lang_pred"] for r in rows] == [w[0] for w in want]
    assert np.allclose([r["score"] for r in rows], [w[1] for w in want], atol=1e-12)
    right = [p["lang_pred"] == r["lang"] for p, r, h in zip(rows, docs, held) if h]
    assert np.mean(right) > 0.97
