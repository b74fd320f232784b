"""Counts against plain code, and what the bands reject."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece

from starweave.llm.quality import quality, script

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(body):
    words = WORD.findall(body)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in body.split("\n"):
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in body), dup, len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def test_counts(docs):
    rng = random.Random(1)
    parts = ["a", "bb\n", "é ", "a b c d e ", "#*", "\n", "\t", "\x0b", "\x1c", " x", "😀 ", "a\nb\n"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 80)))) for i in range(300)] + [(900, None), (901, "")]
    got = quality(docs(*rows), PATH).collect()
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == plain(
            texts[r["_row"]["doc_id"]] or ""
        )


def test_fertility(docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    body = "plain words and 中文字 some 😀 rare ones plain words"
    r = quality(docs((1, body)), PATH).first()
    ids = [t for w in body.split() for t in model.encode(w)]
    n = Counter(ids)
    entropy = -sum(k / len(ids) * math.log2(k / len(ids)) for k in n.values()) / math.log2(len(ids))
    assert r["n_tokens"] == len(ids)
    assert math.isclose(r["chars_per_token"], sum(len(w) for w in body.split()) / len(ids))
    assert math.isclose(r["byte_share"], sum(map(model.is_byte, ids)) / len(ids))
    assert math.isclose(r["token_entropy"], entropy)


def test_bands_reject_what_does_not_fit_the_language(docs):
    rng = random.Random(2)
    vocabulary = "time people water number sound place year back thing name sentence great help line differ".split()
    rows = [(i, " ".join(rng.choices(vocabulary, k=170))) for i in range(200)]
    rows += [(500 + i, "".join(rng.choices("qxzjvkw", k=270)).replace("q", " ")) for i in range(4)]
    rows += [(600 + i, " ".join(chr(rng.randint(0x12000, 0x12300)) for _ in range(45))) for i in range(4)]
    got = {r["_row"]["doc_id"]: r for r in quality(docs(*rows), PATH, group="script").collect()}
    assert all(got[i]["kept"] or got[i]["base_failed"] for i in range(200))
    lang = {r["_row"]["doc_id"]: r for r in quality(docs(*rows), PATH).collect()}
    assert 128 <= min(r["n_tokens"] for r in lang.values())
    strange = [r for i, r in lang.items() if i >= 500 and r["n_tokens"] < 256]
    assert len(strange) >= 4 and all(r["out_of_band"] for r in strange)


def test_thin_classes_are_judged_by_a_wider_band(spark):
    rng = random.Random(3)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    vocabulary = [p[1:] for p in pieces if re.fullmatch("\u2581[a-z]{3,}", p)]
    words = lambda n: " ".join(rng.choices(vocabulary, k=n))
    junk = lambda n: " ".join("".join(rng.choices("qxzjvkw", k=9)) for _ in range(n))
    rows = [(i, words(170), "en") for i in range(60)]
    rows += [(100, words(300), "en"), (101, words(5000), "en"), (102, words(170), "xx"), (103, words(170), None)]
    rows += [(200, junk(60), "en"), (201, junk(2000), "en"), (202, junk(40), "xx"), (203, junk(40), None)]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["_row"]["doc_id"]: r for r in quality(made, PATH).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["out_of_band"] for i in (200, 201, 202, 203))
    assert not any(got[i]["out_of_band"] for i in (*range(60), 100, 101, 102, 103))
    small = {r["_row"]["doc_id"]: r for r in quality(made.filter("doc_id % 3 <> 0 or doc_id > 60"), PATH).collect()}
    assert all(small[i]["out_of_band"] for i in (200, 201, 202, 203))


def test_copies_do_not_make_the_band(spark):
    rng = random.Random(4)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    vocabulary = [p[1:] for p in pieces if re.fullmatch("\u2581[a-z]{3,}", p)]
    rows = [(i, " ".join(rng.choices(vocabulary[: 300 + 40 * (i % 100)], k=150)), "en") for i in range(100)]
    long_ = [v for v in vocabulary if len(v) > 9]
    copy = " ".join(rng.choices(long_, k=150))
    want = {}
    for copies in (1, 150):
        made = rows + [(1000 + i, copy, "en") for i in range(copies)]
        got = quality(spark.createDataFrame(made, "doc_id long, text string, lang string"), PATH).collect()
        want[copies] = {r["_row"]["doc_id"]: r["out_of_band"] for r in got if r["_row"]["doc_id"] <= 1000}
        assert len(got) == len(made) and "same" not in got[0].asDict()
    assert want[1] == want[150] and not any(want[1][i] for i in range(100))


def plain_bands(rows):
    """Bands of (group, length class) from measured rows, set by set."""
    length = lambda r: int(math.log2(max(1, r["n_tokens"])))
    good = list({(r["group"], r["same"]): r for r in rows if not r["base_failed"]}.values())
    out = {}
    for group, k in {(r["group"], length(r)) for r in rows}:
        own = [r for r in good if r["group"] == group]
        sets = [good, own, [r for r in own if abs(length(r) - k) <= 1], [r for r in own if length(r) == k]]
        for m in ("chars_per_token", "byte_share", "token_entropy"):
            value = None
            for some in sets:
                if some:
                    q = np.percentile([round(r[m], 3) for r in some], [25, 50, 75])
                    value = q if value is None else (len(some) * q + 25 * value) / (len(some) + 25)
            reach = max(5 * (value[2] - value[0]), 0.05 if m == "byte_share" else 0.05 * value[1])
            out[group, k, m] = value[1] - reach, value[1] + reach
    return out


def test_verdicts_against_plain_bands(spark):
    rng = random.Random(5)
    words = "time people water number sound place year back thing name sentence great help line differ".split()
    rows = []
    for i in range(240):
        n = rng.choice([12, 40, 41, 170, 600])
        body = " ".join(rng.choice(words) + rng.choice(["", "s", "", "zq"]) + str(rng.randint(0, 99)) for _ in range(n))
        rows.append((i, rng.choice(["", "ü😀 "]) + body, rng.choice(["en", "de", "en", None, "en"])))
    rows += [(300, "".join(rng.choices("qxzjvkw ", k=400)), "de"), (301, None, None), (302, rows[3][1], rows[3][2])]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = quality(made, PATH).collect()
    assert sorted(got) == sorted(quality(made.repartition(7), PATH).collect())
    texts = dict((i, t) for i, t, _ in rows)
    held = [r.asDict() | {"same": texts[r["_row"]["doc_id"]]} for r in got]
    limits = plain_bands(held)
    assert len(got) == len(rows) and 0 < sum(r["out_of_band"] for r in got) < 20
    for r in held:
        k = r["group"], int(math.log2(max(1, r["n_tokens"])))
        low, high = limits[*k, "chars_per_token"]
        outside = not low <= r["chars_per_token"] <= high
        outside |= r["byte_share"] > limits[*k, "byte_share"][1] or r["token_entropy"] < limits[*k, "token_entropy"][0]
        assert r["out_of_band"] == outside and r["kept"] == (not outside and not r["base_failed"])


def test_scripts():
    assert [script(t) for t in ("", "12", "abc", "Привет x", "中文")] == ["NONE", "NONE", "LATIN", "CYRILLIC", "CJK"]


def test_empty_table(docs):
    assert quality(docs(), PATH).count() == 0
