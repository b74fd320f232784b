"""Near duplicates against all pairs."""

from __future__ import annotations

import random

import numpy as np

from pyspark.sql import functions as F

from starweave.llm import components, near, text
from starweave.llm.components import connected
from starweave.llm.scratch import Scratch, gathered


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            here = row[j]
            row[j] = before + 1 if x == y else max(row[j], row[j - 1])
            before = here
    return row[-1]


def similar(a, b):
    a, b = a.split(), b.split()
    if not a or not b:
        return False
    m = lcs(a, b)
    return m >= 0.8 * (len(a) + len(b) - m) - 1e-9


def groups(rows):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if (a or "") == (b or "") or similar(a or "", b or ""):
                root[find(i)] = find(j)
    return {frozenset(k for k in range(len(rows)) if find(k) == r) for r in map(find, range(len(rows)))}


def corpus(rng):
    rows = []
    passage = " ".join(f"p{i}" for i in range(60))
    for _ in range(12):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(30, 200))]
        rows.append(" ".join(words))
        for _ in range(rng.randint(0, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, 6)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = [f"n{rng.randint(0, 999)}"]
            rows.append(" ".join(copy))
    rows += [" ".join(f"u{rng.randint(0, 9999)}" for _ in range(20)) + " " + passage for _ in range(40)]
    rows += ["", None, " ", "one two", "one two", "one two three four", "a " * 300, "a " * 290, rows[0], rows[0]]
    return rows


def test_groups_are_those_of_all_pairs(docs):
    for seed in (1, 2):
        made = [(i, t) for i, t in enumerate(corpus(random.Random(seed)))]
        got = near.near_duplicates(docs(*made)).select("_carry.doc_id", "group", "kept", "keep_id", "group_size").collect()
        assert len(got) == len(made)
        by: dict = {}
        for r in got:
            by.setdefault(r["group"], set()).add(r["doc_id"])
        want = groups([(i, (t or "").strip(" ") if not (t or "").split() and t else t) for i, t in made])
        # Texts without words are similar to equal ones only.
        blank = {i for i, t in made if t == " "}
        want = {g for s in want for g in ([s] if not s & blank or len(s) == 1 else [s - blank, frozenset(blank)])}
        assert {frozenset(s) for s in by.values()} == want
        for r in got:
            members = by[r["group"]]
            assert r["keep_id"] == min(members) and r["kept"] == (r["doc_id"] == min(members))
            assert r["group_size"] == len(members)


def parts(n, pairs):
    """Groups of 0 to n-1 that pairs connect."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        root[find(i)] = find(j)
    by: dict = {}
    for i in range(n):
        by.setdefault(find(i), set()).add(i)
    return {frozenset(s) for s in by.values()}


def found(docs, bodies):
    by: dict = {}
    for r in near.near_duplicates(docs(*enumerate(bodies))).select("_carry.doc_id", "group").collect():
        by.setdefault(r["group"], set()).add(r["doc_id"])
    return {frozenset(s) for s in by.values()}


def linked(bodies):
    words = [w.split() for w in bodies]
    of = [np.array([hash(x) & (2**63 - 1) for x in w], np.uint64) for w in words]
    return [(i, j) for i in range(len(of)) for j in range(i) if near.aligned(of[i], of[j])]


def test_large_bucket_is_linked_through_its_leader(docs, monkeypatch):
    monkeypatch.setattr(near, "SMALL_BUCKET", 3)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(150)]
    bodies = [" ".join(words)]
    for i in range(1, 60):
        copy = list(words)
        for _ in range(2):
            copy[rng.randrange(150)] = f"n{rng.randint(0, 10**6)}"
        bodies.append(" ".join(copy))
    assert all(similar(bodies[0], t) for t in bodies[1:])
    assert len(found(docs, bodies)) == 1


def family(rng, n, words, edits):
    """Texts of which each is an edit of one of the forty before: a family without a centre."""
    bodies = [[f"w{i}" for i in range(words)]]
    while len(bodies) < n:
        copy = list(rng.choice(bodies[-40:]))
        for _ in range(edits):
            copy[rng.randrange(words)] = f"n{rng.randint(0, 10**6)}"
        bodies.append(copy)
    return [" ".join(b) for b in bodies]


def test_a_family_of_a_thousand_without_a_centre(docs):
    """It shares a passage with texts that are not similar to it or to each other."""
    rng = random.Random(7)
    bodies = family(rng, 1000, 120, 3)
    passage = " ".join(f"w{i}" for i in range(60))
    bodies += [" ".join(f"u{rng.randint(0, 9999)}" for _ in range(60)) + " " + passage for _ in range(300)]
    # Each text is an edit of one before: linked to it, but not to those far from it.
    assert not similar(bodies[0], bodies[999])
    got = found(docs, bodies)
    assert frozenset(range(1000)) in got
    assert len(got) == 301


def test_similar_pairs_in_a_crowd_that_shares_a_passage(docs, monkeypatch):
    """Pairs at the threshold among many texts, half of each a passage that all have."""
    monkeypatch.setattr(near, "LEVELS", 2)
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    bodies = []
    for _ in range(150):
        own = [f"u{rng.randint(0, 99999)}" for _ in range(60)]
        bodies.append(" ".join(own + passage))
        copy = own + passage
        for _ in range(9):
            copy[rng.randrange(120)] = f"n{rng.randint(0, 10**6)}"
        bodies.append(" ".join(copy))
    want = linked(bodies)
    assert 140 <= len(want) <= 150
    got = {(max(g), min(g)) for g in found(docs, bodies) if len(g) == 2}
    assert got <= set(want) and len(got) >= 0.9 * len(want)
    assert all(len(g) <= 2 for g in found(docs, bodies))


def test_recall_on_the_near_copies_of_the_documents(spark):
    """Pairs of different texts that share three shingles and 0.3 of all, and 0.8 of their words
    in order."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    group = {r["doc_id"]: r["group"] for r in near.near_duplicates(docs).select("_carry.doc_id", "group").collect()}
    first: dict = {}
    for r in docs.collect():
        first.setdefault(r["text"] or "", r["doc_id"])
    bodies, ids = list(first), list(first.values())
    w = text.words([b.encode() for b in bodies])
    shingle, doc, _ = text.shingles(w, 5)
    of, sizes = np.unique(np.stack([shingle, doc.astype(np.uint64)]), axis=1), {}
    where: dict = {}
    for k, d in of.T.tolist():
        where.setdefault(k, []).append(d)
        sizes[d] = sizes.get(d, 0) + 1
    shared: dict = {}
    for some in where.values():
        for i in some[1:]:
            for j in some[: some.index(i)]:
                shared[j, i] = shared.get((j, i), 0) + 1
    words = [w.hash[i:j] for i, j in zip(w.first, w.first[1:])]
    good = [
        (i, j)
        for (i, j), n in shared.items()
        if n >= 3 and n >= 0.3 * (sizes[i] + sizes[j] - n) and near.aligned(words[i], words[j])
    ]
    assert len(good) > 1000
    hit = sum(group[ids[i]] == group[ids[j]] for i, j in good)
    assert hit >= 0.97 * len(good)


def test_alignment_is_exact(monkeypatch):
    rng = random.Random(4)
    for _ in range(1500):
        k = rng.choice([2, 5, 1000])
        monkeypatch.setattr(near, "FIRST_BAND", rng.choice([1, 3, 32]))
        monkeypatch.setattr(near, "MANY_PLACES", rng.choice([0, 1, 64]))
        a = [rng.randint(0, k) for _ in range(rng.randint(0, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = [rng.randint(0, k)] * rng.randint(0, 1)
        m = lcs(a, b)
        want = m >= 0.8 * (len(a) + len(b) - m) - 1e-9 if a and b else not a and not b
        assert near.aligned(np.array(a, np.uint64), np.array(b, np.uint64)) == want


def test_sketch_keeps_order():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    lines = [words[i : i + 40] for i in range(0, 400, 40)]
    moved = [w for line in rng.sample(lines, len(lines)) for w in line]
    bodies = [" ".join(words), " ".join(moved), " ".join(words) + " end", "", "x"]
    keys = near.sketches(text.words([b.encode() for b in bodies]))
    same, shuffled = (keys[0] == keys[2]).sum(), (keys[0] == keys[1]).sum()
    assert same > 12 and shuffled < same
    assert (keys[3] == 0).all() and (keys[4] != 0).all()


def test_components(spark, scratch):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000)]
    links += [tuple(rng.sample(range(2000, 2100), 2)) for _ in range(60)]
    root = {n: n for e in links for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = connected(spark.createDataFrame(links, "a long, b long"), scratch).collect()
    assert {(r["node"], r["root"]) for r in got} == {(n, find(n)) for n in root if n != 5000}


def test_links_inside_a_part_are_not_followed_again(spark, scratch, monkeypatch):
    """The links of a round are those between parts, not all of them in every round."""
    followed = {}
    keep = Scratch.keep

    def kept(self, df, name, *args, **named):
        out = keep(self, df, name, *args, **named)
        if name.startswith("edges"):
            followed[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "keep", kept)
    star = [(500, i) for i in range(1000) if i != 500]
    got = connected(spark.createDataFrame(star + star, "a long, b long"), scratch).collect()
    assert {(r["node"], r["root"]) for r in got} == {(i, 0) for i in range(1000)}
    assert sum(followed.values()) < 2 * len(star)


def test_few_links_and_classes_need_no_shuffle(spark, scratch):
    made = [scratch.keep(spark.range(100).select("id", (F.col("id") % 7).alias("x")), n) for n in ("a", "b")]
    a, b = gathered(*made)
    plan = a.join(b.hint("merge"), "id").groupBy(a["x"]).count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert gathered(*made, most=99) == tuple(made)


def test_few_pairs_move_their_own_texts_only(spark, scratch, monkeypatch):
    texts = scratch.keep(spark.range(1000).selectExpr("id AS row", "'a b c d e f ' || (id % 2) AS text"), "texts")
    schema = "a long, b long, root_a long, root_b long"
    pairs = scratch.keep(spark.createDataFrame([(1, 3, 1, 3), (1, 5, 1, 5), (1, 2, 1, 2)], schema), "pairs")
    some = near.verified(pairs, texts)
    assert "LeftSemi" in some._jdf.queryExecution().optimizedPlan().toString()
    want = {(1, 3, 1, 3), (1, 5, 1, 5)}
    assert {tuple(r) for r in some.collect()} == want
    monkeypatch.setattr(near, "SENT_PAIRS", 2)
    assert {tuple(r) for r in near.verified(pairs, texts).collect()} == want
    assert near.verified(pairs.filter("a < 0"), texts).isEmpty()


def test_rounds_of_many_links_are_shuffled(spark, scratch, monkeypatch):
    monkeypatch.setattr(components, "TASK_LINKS", 10)
    links = [(i, i + 1) for i in range(100)] + [(1000 + i, 1001 + i // 2) for i in range(40)]
    got = connected(spark.createDataFrame(links, "a long, b long"), scratch).collect()
    want = parts(1100, links)
    assert {(r["node"], r["root"]) for r in got} == {(n, min(g)) for g in want if len(g) > 1 for n in g}


def test_empty_table(docs):
    assert near.near_duplicates(docs()).count() == 0
    assert near.near_duplicates(docs((1, None), (None, "x"))).count() == 2


def test_clashing_and_null_columns(spark):
    schema = "doc_id long, text string, row string, class int, bucket int, n long, root string, kept int"
    body = " ".join(f"w{i}" for i in range(30))
    rows = [(None, body, "r", 1, 2, 3, "x", 0), (2, f"{body} more", None, None, None, None, None, None), (3, None, "r", 1, 2, 3, "x", 0)]
    got = near.near_duplicates(spark.createDataFrame(rows, schema), carry=("kept", "class")).collect()
    assert sorted(r["group_size"] for r in got) == [1, 2, 2]
    assert {r["keep_id"] for r in got} == {2, 3}


def test_long_texts_align_in_narrow_bands():
    """60,000 words with 2,000 changes take less than a few seconds."""
    import time

    rng = random.Random(9)
    a = np.array([rng.randint(0, 20000) for _ in range(60000)], np.uint64)
    b = a.copy()
    for _ in range(2000):
        b[rng.randrange(len(b))] = 10**6 + rng.randint(0, 10**6)
    start = time.perf_counter()
    assert near.aligned(a, b[100:])
    assert time.perf_counter() - start < 5


def test_large_buckets_with_one_leader_are_one(spark, monkeypatch):
    """A class has one row for the large buckets that it shares with a leader, small ones stay apart."""
    monkeypatch.setattr(near, "SMALL_BUCKET", 3)
    rows = [(100 + b, c, c, None) for b in range(9) for c in range(5)]
    rows += [(200 + b, c, c, None) for b in range(2) for c in (b, 7)]
    made = spark.createDataFrame(rows, "bucket long, class long, root long, parent long")
    # Buckets of the same classes are one already.
    made = made.unionAll(made.filter("bucket < 109").selectExpr("bucket", "10 + bucket", "10 + bucket", "parent").distinct())
    sized = near._sized(made)
    leads = {r["bucket"]: r["lead"] for r in sized.collect()}
    got = near._by_bucket(near._by_class(sized)).collect()
    large = [(r["class"], r["lead"]) for r in got if r["n"] > 3]
    assert len(large) == len(set(large))
    for bucket, of, _, _ in (r for r in made.collect() if r["bucket"] in leads and r["bucket"] < 200):
        assert (of, leads[bucket]) in large
    small = {(r["bucket"], r["class"]) for r in got if r["n"] <= 3}
    assert small == {(b, c) for b, c, *_ in rows if b >= 200}
