"""The classifier on held-out rows and misspellings."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starweave.llm import toxicity

STEMS = ["grumbolt", "snarkfen", "vexilor"]
LABELS = "doc_id long, quality int, toxic int"


def corpus(rng, n):
    clean = ["".join(rng.choices("aeioulmnrst", k=rng.randint(2, 8))) for _ in range(600)]
    rows = []
    for i in range(n):
        words = rng.choices(clean, k=rng.randint(15, 250))
        toxic = int(rng.random() < 0.3)
        for _ in range(toxic * rng.randint(2, 5)):
            words.insert(rng.randint(0, len(words)), rng.choice(STEMS) + rng.choice(["", ".", "s", "ed", "!"]))
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus(random.Random(1), 900)


@pytest.fixture(scope="module")
def model(rows):
    some = rows[:600]
    return toxicity.train([t for _, t, _ in some], [y for *_, y in some])


def test_held_out_rows(rows, model):
    rest = rows[600:]
    y = np.array([r[2] for r in rest])
    score = model.scores([r[1] for r in rest])
    assert ((score >= 0.5) == y).mean() > 0.97
    assert ((score >= 0) & (score <= 1)).all()


def test_unseen_misspellings_share_ngrams(rows, model):
    clean = next(t for _, t, y in rows[600:] if not y)
    wrong = ["grumboltz", "snarkfenn", "xvexilor"]
    plain = ["aeioulmnz", "rstaeiou", "xmlunior"]
    odds = model.margins(toxicity.windows([f"{clean} {w}" for w in wrong + plain]))
    assert odds[:3].min() > odds[3:].max()


def test_blocks_do_not_change_scores(rows, model):
    texts = [t for _, t, _ in rows[:60]] + ["", "...", "A b", "Ünïcode \U0001f600 中文"]
    together = model.scores(texts)
    alone = np.array([model.scores([t])[0] for t in texts])
    assert np.allclose(together, alone)
    assert together[60] == together[61] == 1 / (1 + np.exp(-model.bias))


def test_joined_windows_are_those_of_all_texts(rows):
    texts = [t for _, t, _ in rows[:50]]
    whole = toxicity.windows(texts)
    parts = toxicity.joined([toxicity.windows(texts[i : i + 7]) for i in range(0, 50, 7)])
    assert (whole.doc == parts.doc).all() and (whole.start == parts.start).all()
    model = toxicity.Model(np.random.default_rng(1).normal(size=toxicity.BUCKETS), 0.1)
    assert np.allclose(model.margins(whole), model.margins(parts))


def test_query_learns_from_four_fifths_only(spark, docs, rows, tmp_path):
    from starweave.llm.queries import op1_toxicity

    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    made = docs(*((i, t) for i, t, _ in rows), (None, None), (5000, None), (5001, ""), (5001, ""))
    made.write.parquet(str(tmp_path / "documents.parquet"))
    # Labels of held-out rows are wrong: they must not be learnt from.
    marks = [(i, 1, 1 - y if held(i) else y) for i, _, y in rows] + [(None, None, 1), (3, None, None), (77777, 0, 1)]
    spark.createDataFrame(marks, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    got = op1_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + 4
    truth = {i: y for i, _, y in rows}
    assert all(r["held_out"] == (r["doc_id"] is not None and held(r["doc_id"])) for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got)
    known = [r for r in got if r["doc_id"] in truth and r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in known) > 0.95 * len(known)


def test_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], LABELS)
    model = toxicity.fit(docs((1, "a")), none)
    assert [r["score"] for r in toxicity.score(docs((1, "a"), (2, None)), model).collect()] == [0.5, 0.5]
    assert toxicity.score(docs(), model).count() == 0
    one = spark.createDataFrame([(1, 1, 1)], LABELS)
    assert toxicity.fit(docs((1, "a")), one).bias == 0


def test_fit_in_a_task_is_training_on_the_same_rows(spark, docs, rows):
    made = docs(*((i, t) for i, t, _ in rows[:200]), (5000, "grumbolt " * 90_000), (5001, None))
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows[:200]] + [(5000, 1, 1), (5001, 1, 0)], LABELS)
    order = {r["doc_id"]: n for n, r in enumerate(labels.orderBy(F.xxhash64("doc_id")).collect())}
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    # A text beyond the bound of characters is passed over, the rest is learnt from.
    want = sorted((order[i], t, y) for i, t, y in [*rows[:200], (5001, "", 0)] if not held(i))
    plain = toxicity.train([t for _, t, _ in want], [y for *_, y in want])
    got = toxicity.fit(made.repartition(5), labels, most_chars=800_000)
    assert np.allclose(got.bucket, plain.bucket, atol=1e-4) and abs(got.bias - plain.bias) < 1e-6
    assert got.bucket.any()


def test_kept_rows_have_all_their_columns(spark, docs):
    rng = random.Random(2)
    rows = corpus(rng, 300)
    made = docs(*((i, t) for i, t, _ in rows)).selectExpr("*", "'x' AS score", "1 AS `_row`")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], LABELS)
    kept = toxicity.drop_toxic(made, labels)
    assert kept.dtypes == made.dtypes
    ids = {r["doc_id"] for r in kept.collect()}
    wrong = sum((i in ids) == bool(y) for i, _, y in rows)
    assert wrong < 20
