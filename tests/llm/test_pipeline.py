"""Every stage of the pipeline against what it should keep, and the whole of it."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest

from starweave.llm.near import near_duplicates

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture
def folder(spark, docs, tmp_path):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("aeioulmnrst", k=5)) for _ in range(800)]
    rows, labels, copies, near, toxic = [], [], {}, {}, set()
    for i in range(150):
        words = rng.choices(vocabulary, k=rng.randint(40, 150))
        if i % 4 == 0:
            for _ in range(4):
                words.insert(rng.randint(0, len(words)), rng.choice(["grumbolt", "snarkfen"]))
            toxic.add(i)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i in toxic)))
    for k, i in enumerate(range(1, 60, 2)):
        rows.append((1000 + k, rows[i][1]))
        copies[1000 + k] = i
        words = rows[i][1].split()
        words[3] = "changed"
        rows.append((2000 + k, " ".join(words * 1)))
        near[2000 + k] = i
    rows += [(None, None), (3000, "")]
    docs(*rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    return tmp_path, toxic, copies, near


def test_stages(spark, folder):
    path, toxic, copies, near = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    stored = lambda k, df: (df.write.parquet(f"{path}/stage-{k}"), spark.read.parquet(f"{path}/stage-{k}"))[1]
    clean = stored(0, stages[0](spark, docs, str(path)))
    assert clean.columns == docs.columns
    assert len(ids(docs) - ids(clean) - toxic) == 0 and len(toxic & ids(clean)) <= 6
    once = stored(1, stages[1](spark, clean, str(path)))
    assert once.schema.names == docs.columns
    texts = [r["text"] for r in once.collect()]
    assert len(texts) == len(set(texts))
    assert all(i not in ids(once) or c not in ids(clean) for c, i in copies.items())
    apart = stored(2, stages[2](spark, once, str(path)))
    groups = near_duplicates(once).select("group").distinct().count()
    assert apart.count() == groups
    assert not ids(apart) & set(near) & {n for n in near if copies.get(n - 1000) in ids(apart)}
    mixed = stored(3, stages[3](spark, apart, str(path)))
    assert mixed.columns == docs.columns and ids(mixed) <= ids(apart)
    words = sum(len(r["text"].split()) for r in apart.collect())
    assert abs(sum(len(r["text"].split()) for r in mixed.collect()) - 1.5 * words) < 5
    packed = stages[4](spark, mixed, str(path)).collect()
    total = sum(r["length"] for r in packed)
    assert max(r["sequence_id"] for r in packed) == (total - 1) // 2048


def test_run_and_registration(spark, folder):
    import __spark_entry__

    path = str(folder[0])
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, path).count() > 0


def test_empty_tables(spark, docs, tmp_path):
    docs().write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
