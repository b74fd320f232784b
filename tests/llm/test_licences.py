"""Licence scans against plain search."""

from __future__ import annotations

import random
import re

from starweave.llm import licences, text
from starweave.llm.licence_texts import TEMPLATES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(body):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in body)


def longest_matches(template, body):
    """Length of the longest run of the template that ends at each symbol."""
    runs = {tuple(template[i:j]) for i in range(len(template)) for j in range(i + 1, len(template) + 1)}
    out = []
    for end in range(1, len(body) + 1):
        n = 0
        while n < end and tuple(body[end - n - 1 : end]) in runs:
            n += 1
        out.append(n)
    return out


def test_matching_statistics():
    rng = random.Random(1)
    for _ in range(150):
        sequences = [[rng.randint(0, 3) for _ in range(rng.randint(1, 15))] for _ in range(3)]
        automaton = licences.Automaton.of(sequences, 2)
        body = [rng.randint(0, 4) for _ in range(30)]
        want = [max(n) for n in zip(*(longest_matches(s, body) for s in sequences))]
        got = list(automaton.read(body))
        assert [n for _, n in got] == want
        for i, (state, n) in enumerate(got):
            if n >= 2:
                run = body[i + 1 - n : i + 1]
                places = {
                    (s, e) for s, q in enumerate(sequences) for e in range(n, len(q) + 1) if q[e - n : e] == run
                }
                assert places == set(automaton.places[state])


def test_base_phrases(docs):
    rng = random.Random(2)
    parts = ["MIT License", "mit", "license", "Apache\nLicense,", "General-Public license", "é", "ÉMIT license", " ", ". ", "x1"]
    rows = [(i, " ".join(rng.choices(parts, k=rng.randint(0, 20)))) for i in range(150)] + [(900, None), (901, "")]
    texts = dict(rows)
    for r in licences.labelled(licences.scan(docs(*rows))).collect():
        words = WORD.findall(lower(texts[r["_row"]["doc_id"]] or ""))
        places = [
            (i, label)
            for phrase, label in licences.PHRASES
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        assert r["n_words"] == len(words) and r["n_base"] == len(places)
        assert r["first_word"] == min((i for i, _ in places), default=None)
        assert r["last_word"] == max((i for i, _ in places), default=None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1


def test_templates_with_edits_are_covered(docs):
    rng = random.Random(3)
    rows, labels = [], {}
    for label, (body,) in TEMPLATES.items():
        words = body.split()
        for k in range(3):
            copy = list(words)
            for _ in range(k):
                copy[rng.randrange(len(copy))] = "changed"
            i = len(rows)
            rows.append((i, "before it some prose " + " ".join(copy) + " and after it"))
            labels[i] = label
    rows.append((999, "the software is provided in the hope that it works for any purpose"))
    for r in licences.labelled(licences.scan(docs(*rows))).collect():
        i = r["_row"]["doc_id"]
        if i == 999:
            assert r["labels"] == "" and r["score"] == 0
        else:
            assert labels[i] in r["labels"].split(",") and r["score"] > 0.8
            best = max(r["spans"], key=lambda s: s["share"])
            assert best["label"] == labels[i] and best["start"] in range(4, 12)


def test_empty_table(docs):
    assert licences.labelled(licences.scan(docs())).count() == 0


def test_words_do_not_cross_texts():
    w = text.words([b"mit", b"license"], licences.WORD)
    assert licences.Scanner().base(w) == [[], []]
