"""Near duplicates by order MinHash and banded alignment."""

from __future__ import annotations

from bisect import bisect_left
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starweave.llm import text
from starweave.llm.components import connected
from starweave.llm.scratch import TASK_ROWS, Scratch, gathered

SHINGLE = 5
SIMILARITY = 0.8
#: Samples of a sketch, and shingles in each.
SAMPLES = 16
PICKED = 2
#: Classes of a bucket whose pairs are all compared, if its leader does not connect them.
SMALL_BUCKET = 16
#: Length of a shingle, samples and shingles in each of the sketches that large buckets are cut
#: by. Texts of similarity 0.8 have that share of their labelled words in common, so they agree in a
#: sample with a chance of 0.4; texts that share half of their words, in one passage, with one
#: of 0.01 to 0.06. (Of five-word shingles both kinds would share about as many.)
FINE = (1, 8, 4)
#: Fine samples that a class and the leader of its bucket agree in if they are of one family, and
#: the share of such classes that makes a bucket a family's.
ALIKE, FAMILY = 2, 0.5
#: Times that a bucket of dissimilar texts is cut by fresh samples, before what is left of it is
#: treated like a family.
LEVELS = 4
#: Classes of a block, and words of its texts, at most on the average.
BLOCK, BLOCK_WORDS = 512, 2_000_000
#: Places of a word in a text from which its alignment keeps them as one number.
MANY_PLACES = 64
#: Half the width of the first band that an alignment tries.
FIRST_BAND = 32
#: Pairs of texts that a task aligns, where there are fewer than fill all tasks of a shuffle.
TASK_PAIRS = 100
#: Pairs whose ids are sent to every task that reads texts, 16 bytes each.
SENT_PAIRS = 50_000
#: Two classes, and the roots that they had when their link was asked for.
PAIR = ("a", "b", "root_a", "root_b")


def sketches(
    w: text.Words, k: int = SHINGLE, samples: int = SAMPLES, picked: int = PICKED, level: int = 0
) -> np.ndarray:
    """Order MinHash of each text: (texts, samples) keys; a text without words gets 0. Each
    ``level`` has samples of its own.

    A shingle is labelled with its occurrence number. Each sample has its own random
    order of labelled shingles, takes the ``picked`` lowest of a text and hashes them in
    the order in which they stand there. So equal keys ask for equal shingles in equal
    order. A text with fewer shingles takes all.
    """
    shingle, doc, _ = text.shingles(w, k)
    out = np.zeros((w.n_docs, samples), np.uint64)
    if not len(shingle):
        return out
    label = text.mix(shingle + text.seeded(1, 21) * text.occurrence(shingle, doc).astype(np.uint64))
    bounds = np.searchsorted(doc, np.arange(w.n_docs + 1))
    some = np.flatnonzero(np.diff(bounds))
    begin, size = bounds[some], np.diff(bounds)[some]
    salt = text.seeded(picked, 22) | np.uint64(1)
    for s, seed in enumerate(text.seeded(samples, 23 + 100 * level)):
        value = text.mix(label ^ seed)
        found = []
        for j in range(picked):
            low = np.minimum.reduceat(value, begin)
            # The first place of the minimum; the highest value marks what was taken.
            hit = np.flatnonzero(value == np.repeat(low, size))
            first = hit[np.searchsorted(hit, begin)]
            found.append(np.where(j < size, first, -1))
            value[first] = np.uint64(0xFFFFFFFFFFFFFFFF)
        at = np.sort(np.stack(found), axis=0)
        key = np.zeros(len(some), np.uint64)
        for j in range(picked):
            part = np.where(at[j] >= 0, label[np.maximum(at[j], 0)], 0)
            key += part * salt[j]
        out[some, s] = text.mix(key) | np.uint64(1)
    return out


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two sequences are similar in order: m / (len(a) + len(b) - m) reaches
    ``similarity``, with m the length of their longest common subsequence.

    At most ``room`` items of both may then stay unaligned, so a path leaves the main
    diagonal by no more than that. Narrower bands are tried first: what they align is a
    lower bound, which mostly settles it. The widest one is exact.
    """
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return not total
    room = int(total - 2 * np.ceil(similarity * total / (1 + similarity) - 1e-9))
    least = (total - room) // 2
    if abs(len(a) - len(b)) > room or min(len(a), len(b)) < least:
        return False
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    need = least - head - tail
    if need <= 0:
        return True
    if min(len(a), len(b)) < need or _common(a, b) < need:
        return False
    where: dict[int, list[int]] = {}
    for i, x in enumerate(a.tolist()):
        where.setdefault(x, []).append(i)
    columns = b.tolist()
    band = min(FIRST_BAND, room)
    while banded(where, len(a), columns, band) < need:
        if band == room:
            return False
        band = min(4 * band, room)
    return True


def banded(where: dict[int, list[int]], n: int, columns: list[int], band: int) -> int:
    """Longest common subsequence of two sequences with matches at most ``band`` off the
    main diagonal. ``where`` has the places of each item of the first one, ``n`` long.

    Columns of the alignment are bits of one number, which holds the band only: bit i falls
    when the best path to item ``low + i`` gains one. Bits that leave the band are counted.
    """
    # Items in many places of a wide band are found by one shift each.
    masks = {}
    if band > MANY_PLACES:
        masks = {x: sum(1 << i for i in at) for x, at in where.items() if len(at) > MANY_PLACES}
    width = 2 * band + 1
    full = bits = (1 << width) - 1
    low = gained = 0
    for j, x in enumerate(columns):
        if j > band:
            gained += not bits & 1
            bits = bits >> 1 | 1 << (width - 1)
            low += 1
        if x in masks:
            match = masks[x] >> low & (1 << (j + band - low + 1)) - 1
        else:
            match = 0
            at = where.get(x, ())
            for k in range(bisect_left(at, low), len(at)):
                if at[k] > j + band:
                    break
                match |= 1 << (at[k] - low)
        if match:
            hit = bits & match
            bits = ((bits + hit) | (bits - hit)) & full
    return gained + width - bits.bit_count()


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Items that both have, with repeats: no alignment has more."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def _sketch(level: int):
    """A function that adds the sketches of a level to batches of texts."""

    def add(batches):
        for batch in text.blocks(batches, "text"):
            w = text.words(text.encoded(batch.column("text")))
            keys = sketches(w, *(FINE if level else ()), level=level).view(np.int64)
            flat = pa.array(keys.reshape(-1))
            offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1])
            rest = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in rest),
                    pa.ListArray.from_arrays(offsets, flat),
                    pa.array(np.diff(w.first).astype(np.int64)),
                ],
                names=[*rest, "keys", "length"],
            )

    return add


def _word_lists(column: pa.Array) -> list[np.ndarray]:
    """The words of each text as 64-bit hashes."""
    w = text.words(text.encoded(column))
    return [w.hash[i:j] for i, j in zip(w.first, w.first[1:])]


def _verify(batches):
    """Pairs whose texts align, word by word over the whole texts."""
    for batch in text.blocks(batches, "text_a", "text_b"):
        sides = [_word_lists(batch.column(name)) for name in ("text_a", "text_b")]
        good = [aligned(a, b) for a, b in zip(*sides)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in PAIR), pa.array(good, pa.bool_())], names=[*PAIR, "good"]
        )


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of stored pairs (a, b) of row numbers and their roots, those whose texts align. The ids of
    up to ``SENT_PAIRS`` of them go to every task, so that only their texts are moved."""
    n = pairs.count()
    if not n:
        return pairs
    if n <= SENT_PAIRS:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
        texts = texts.join(F.broadcast(ids), "row", "left_semi")
    left = texts.select(F.col("row").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("row").alias("b"), F.col("text").alias("text_b"))
    met = pairs.join(left, "a").join(right, "b")
    # Few pairs are not worth a Python worker for each partition of the joins.
    tasks = 1 + n // TASK_PAIRS
    if tasks < int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        met = met.coalesce(tasks)
    columns = ", ".join(f"{n} long" for n in PAIR)
    checked = met.select(*PAIR, "text_a", "text_b").mapInArrow(_verify, f"{columns}, good boolean")
    return checked.filter("good").drop("good")


def _compare(table: pa.Table) -> pa.Table:
    """Links between the roots of two blocks of a family, or of one. Pairs of classes that share a
    sample are aligned, those that share most first, unless they are connected by then."""
    table = table.combine_chunks().sort_by("class")
    first = table["root"].to_pylist()
    part = table["own"].to_numpy()
    keys = table["keys"].combine_chunks().flatten().to_numpy().reshape(len(first), -1)
    agree = np.zeros((len(first), len(first)), np.uint8)
    for s in range(keys.shape[1]):
        agree += keys[:, s][:, None] == keys[:, s][None, :]
    _, group = np.unique(first, return_inverse=True)
    todo = np.triu(agree > 0, 1) & (group[:, None] != group[None, :])
    if table["lo"][0] != table["hi"][0]:
        todo &= part[:, None] != part[None, :]
    a, b = np.nonzero(todo)
    order = np.argsort(-agree[a, b].astype(np.int16), kind="stable")
    used = np.unique(np.concatenate((a, b)))
    words = dict(zip(used.tolist(), _word_lists(table["text"].combine_chunks().take(pa.array(used)))))
    root = list(range(len(first)))  # of groups

    def find(r):
        while root[r] != r:
            root[r] = r = root[root[r]]
        return r

    links = []
    for i, j in zip(a[order].tolist(), b[order].tolist()):
        x, y = find(group[i]), find(group[j])
        if x != y and aligned(words[i], words[j]):
            root[x] = y
            links.append((first[i], first[j]))
    return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])


def family_links(near: DataFrame, label: DataFrame, keys: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) between the roots of classes of families, which ``near`` (a, b) tells of. ``label``
    has the root of each linked class.

    A class is in one family only, however many buckets tell so. The classes of a family
    are dealt into blocks, and each two blocks are a group: a class is sent once for each block.
    """
    family = connected(near, scratch.sub("families")).select(F.col("node").alias("class"), F.col("root").alias("family"))
    rows = _rooted(family.withColumn("root", F.col("class")), label)
    held = rows.join(keys.hint("merge"), "class").join(texts.withColumnRenamed("row", "class"), "class")
    ends = held.groupBy("family").agg(
        F.min("root").alias("_lo"), F.max("root").alias("_hi"), F.count("*").alias("n"), F.sum("length").alias("total")
    )
    apart = scratch.keep(ends.filter("_lo <> _hi"), "families-apart")
    parts = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("total") / BLOCK_WORDS)).cast("int")
    dealt = (
        held.join(apart.select("family", parts.alias("parts")), "family")
        .withColumn("own", F.pmod(F.xxhash64("class", F.lit(1)), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "family", "class", "root", "own", "keys", "text",
            F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        )
    )
    tasks = int(near.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = dealt.repartition(tasks, "family", "lo", "hi").groupBy("family", "lo", "hi")
    return groups.applyInArrow(_compare, "a long, b long")


def _pairs(a: Column, b: Column, root_a: Column, root_b: Column) -> list[Column]:
    ends = (F.least(a, b), F.greatest(a, b), F.least(root_a, root_b), F.greatest(root_a, root_b))
    return [end.alias(name) for end, name in zip(ends, PAIR)]


def leader_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of each class with the leader of its bucket, where they are not connected yet: one
    for each class of a bucket, whatever its size."""
    met = rows.filter("root <> lead_root")
    return met.select(*_pairs(*map(F.col, ("class", "lead", "root", "lead_root")))).dropDuplicates()


def judged(rows: DataFrame, keys: DataFrame, few: bool = False) -> DataFrame:
    """Rows of large buckets, with their keys and whether the bucket is a family's: most
    of its classes then agree with the leader in several samples. A passage that many
    dissimilar texts share brings them together in few."""
    led = keys.select(F.col("class").alias("lead"), F.col("keys").alias("_keys"))
    same = F.size(F.filter(F.zip_with("keys", "_keys", lambda a, b: a == b), lambda e: e))
    told = rows.join(led.hint("merge"), "lead").select(
        "bucket", "class", "root", "parent", "keys", "lead", (same >= ALIKE).cast("int").alias("_alike")
    )
    told = _few(told, few)
    # A cut that leaves most of a bucket together has found a family too.
    whole = F.coalesce(F.count("*") > FAMILY * F.max("parent"), F.lit(False))
    share = told.groupBy("bucket").agg(
        F.count("*").alias("n"), ((F.avg("_alike") >= FAMILY) | whole).alias("family")
    )
    return told.drop("_alike").join(share.hint("merge"), "bucket")


def _by_class(rows: DataFrame, few: bool = False) -> DataFrame:
    """A row for each class, with its buckets: what is known of classes meets one row of each.

    Large buckets with the same leader become one, of all their classes: a class is there
    once, however many samples it shares with the leader, and no pair that shared a bucket is parted.
    """
    large = F.col("n") > SMALL_BUCKET
    one = F.when(large, F.xxhash64("lead", F.lit(5))).otherwise(F.col("bucket")).alias("bucket")
    met = rows.select("class", "root", one, "n", "parent", "lead", "lead_root")
    met = met if few else met.repartition("class")  # ``few`` are in one partition
    told = [F.max(c).alias(c) for c in ("n", "parent", "lead", "lead_root")]
    once = met.groupBy("class", "bucket").agg(F.min("root").alias("root"), *told)
    return once.groupBy("class").agg(
        F.min("root").alias("root"), F.collect_list(F.struct("bucket", "n", "parent", "lead", "lead_root")).alias("in")
    )


def _few(rows: DataFrame, few: bool) -> DataFrame:
    """Of joined tables of one partition Spark no longer sees that they are in one."""
    return rows.coalesce(1) if few else rows


def _by_bucket(held: DataFrame, *more: str) -> DataFrame:
    return held.select("class", "root", *more, F.inline("in"))


def cross_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of classes of a small bucket that are not connected."""
    other = rows.select("bucket", F.col("class").alias("other"), F.col("root").alias("other_root"))
    met = rows.join(other.hint("merge"), "bucket").filter("class < other AND root <> other_root")
    return met.select(*_pairs(*map(F.col, ("class", "other", "root", "other_root")))).dropDuplicates()


def _rooted(rows: DataFrame, label: DataFrame) -> DataFrame:
    """``rows`` with a new ``root``: that which ``label`` (node, root) has for the one before."""
    new = label.select(F.col("node").alias("root"), F.col("root").alias("_root"))
    return rows.join(new.hint("merge"), "root", "left").withColumn("root", F.coalesce("_root", "root")).drop("_root")


def _between_roots(links: DataFrame) -> DataFrame:
    return links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))


def _apart(rows: DataFrame) -> DataFrame:
    """Rows of the buckets whose classes are not all connected."""
    ends = rows.groupBy("bucket").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi"))
    return rows.join(ends.filter("_lo <> _hi").select("bucket").hint("merge"), "bucket")


def _sized(rows: DataFrame) -> DataFrame:
    """Rows (``bucket``, ``class``, ``root``) of buckets of several classes, with their number
    ``n`` and leader. Of buckets with the same classes one will do.

    The leader is the class with the lowest hash: so the buckets of a family mostly have
    the same one, and a class meets few.
    """
    lead = F.min(F.struct(F.xxhash64("class", F.lit(3)).alias("_h"), "class", "root")).alias("_lead")
    marks = [F.bit_xor(F.xxhash64("class", F.lit(4 + i))).alias(f"_mark{i}") for i in range(2)]
    company = rows.groupBy("bucket").agg(F.count("*").alias("n"), lead, *marks).filter("n > 1")
    once = company.groupBy("n", "_mark0", "_mark1").agg(F.min("bucket").alias("bucket"), F.min("_lead").alias("_lead"))
    known = once.select("bucket", "n", F.col("_lead.class").alias("lead"), F.col("_lead.root").alias("lead_root"))
    return rows.join(known.hint("merge"), "bucket")


def near_groups(stored: DataFrame, scratch: Scratch) -> DataFrame:
    """Classes of equal texts (``row``, ``class``) with their ``root``: the lowest class of those that
    links between similar ones connect. ``stored`` has ``row`` and ``text``.

    1. Every text gets its sketch. Equal texts become one class, named by its lowest
       row number. Classes with an equal sample share a bucket.
    2. Each class of a bucket is aligned with the bucket's leader: as many pairs as classes.
       That connects families of similar texts.
    3. In small buckets, pairs that are not connected then are all aligned.
    4. Of larger ones, those that hold a family of alike texts make up one group with all others
       that share its classes; its pairs that are not connected are compared in blocks.
    5. The rest hold dissimilar texts that share a passage. They get fresh samples, and
       classes that share the bucket and a fresh sample share a bucket of the next
       level: dissimilar texts rarely agree again, similar ones mostly do.
    """
    same = F.sha2("text", 256).alias("same")
    sketch = scratch.keep(
        stored.select("row", same, "text").mapInArrow(
            _sketch(0), "row long, same string, keys array<long>, length long"
        ),
        "sketch",
    )
    # Equal texts have equal sketches: any one of them will do.
    classes = scratch.keep(
        sketch.groupBy("same").agg(
            F.min("row").alias("class"), F.max(F.struct("length", "keys")).alias("_s")
        ),
        "classes",
    )
    member = sketch.select("row", "same").join(classes.select("same", "class"), "same")
    member = scratch.keep(member.select("row", "class"), "members")
    every = classes.select("class", F.posexplode("_s.keys").alias("sample", "key")).filter("key <> 0")
    buckets = every.select("class", F.xxhash64("sample", "key").alias("bucket"))
    rows = buckets.select("*", F.col("class").alias("root"), F.lit(None).cast("long").alias("parent"))
    held = scratch.keep(_by_class(_sized(rows)), "held-0")
    # As many as there are copies: a side that grows with the input, not to be broadcast.
    wanted = held.select(F.col("class").alias("row"))
    texts = scratch.keep(stored.select("row", "text").join(wanted.hint("merge"), "row"), "texts")
    crossed = wanted.sparkSession.createDataFrame([], ", ".join(f"{n} long" for n in PAIR))
    near = crossed.select("a", "b")
    labels = []
    first = None
    level = 0
    while True:
        (held,) = gathered(held)
        asked = scratch.keep(leader_pairs(_by_bucket(held)), f"leads-{level}")
        led = scratch.keep(verified(asked, texts), f"led-{level}")
        # What was connected before is one root.
        labels.append(connected(_between_roots(crossed.unionAll(led)), scratch.sub(f"roots-{level}")))
        (rooted,) = gathered(scratch.keep(_rooted(*gathered(held, labels[-1])), f"rooted-{level}"))
        rows = _by_bucket(rooted)
        # Of two classes the only pair has been aligned.
        asked = scratch.keep(cross_pairs(rows.filter(f"n > 2 AND n <= {SMALL_BUCKET}")), f"crosses-{level}")
        crossed = scratch.keep(verified(asked, texts), f"crossed-{level}")
        few = rooted.count() <= TASK_ROWS
        large = scratch.keep(_by_class(_apart(rows.filter(f"n > {SMALL_BUCKET}")), few), f"large-{level}")
        if large.isEmpty():
            break
        level += 1
        fresh = texts.join(large.select(F.col("class").alias("row")), "row")
        fresh = fresh.mapInArrow(_sketch(level), "row long, keys array<long>, length long")
        keys = scratch.keep(fresh.withColumnRenamed("row", "class"), f"fresh-{level}")
        first = first or keys
        few = large.count() <= TASK_ROWS
        large, keys = gathered(large, keys)
        known = _few(large.join(keys.hint("merge"), "class"), few)
        told = judged(_by_bucket(known, "keys"), keys, few)
        told = scratch.keep(told, f"judged-{level}")
        family = F.col("family") if level <= LEVELS else F.lit(True)
        near = near.unionAll(told.filter(family).select(F.col("class").alias("a"), F.col("lead").alias("b")))
        cut = (
            _few(told, few)
            .filter(~family)
            .select("bucket", "class", "root", F.col("n").alias("parent"), F.posexplode("keys").alias("sample", "key"))
            .select(F.xxhash64("bucket", "sample", "key").alias("bucket"), "class", "root", "parent")
        )
        held = scratch.keep(_by_class(_sized(cut), few), f"held-{level}")
    # All links, each by what it joined: a label tells of the roots that became one.
    stars = [label.select(F.col("node").alias("a"), F.col("root").alias("b")) for label in labels]
    label = connected(reduce(DataFrame.unionAll, stars, _between_roots(crossed)), scratch.sub("linked"))
    grouped = _rooted(member.withColumn("root", F.col("class")), label)
    if first is None:
        return grouped
    more = scratch.keep(family_links(near, label, first, texts, scratch), "family-links")
    return _rooted(grouped, connected(more, scratch.sub("groups")))


def near_duplicates(
    docs: DataFrame, order: str = "doc_id", carry: tuple[str, ...] = (), scratch: Scratch | None = None
) -> DataFrame:
    """Rows with their class of equal texts and their group of near duplicates.

    Texts are sequences of words, which are parted by white space. Two are near duplicates if
    a longest common subsequence of m words gives m / (n1 + n2 - m) >= 0.8 and their
    sketches, samples of five-word shingles (a text of 1 to 4 words is one), meet: that is
    likely, see ``near_groups``, but for texts of a few words, where one change leaves no shingle.
    Groups are connected by such pairs and by equality.

    A null text counts as empty. Texts without words are similar to equal ones only. An empty
    table gives none; further columns are kept only as ``carry``.
    Repeated rows are rows of their own, ids may be null; no two rows of a group are
    kept. The row with the lowest ``order`` (null is last), then the lowest number, stays.
    Returns ``row``, the ``carry`` columns as ``_carry``, ``text``, ``class`` and ``group``
    (row numbers), ``group_size``, ``kept`` and ``keep_id``.
    """
    scratch = scratch or Scratch(docs.sparkSession, "near")
    columns = dict.fromkeys([order, *carry])
    stored = scratch.keep(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_carry"),
            F.coalesce("text", F.lit("")).alias("text"),
        ),
        "rows",
    )
    grouped = near_groups(stored.select("row", "text"), scratch)
    grouped = scratch.keep(grouped.select("row", "class", F.col("root").alias("group")), "grouped")
    # A null id comes after all others.
    key = F.col(f"_carry.`{order}`")
    rank = F.struct(key.isNull().alias("_null"), key.alias("_id"), "row")
    best = scratch.keep(
        grouped.join(stored.select("row", "_carry"), "row")
        .groupBy("group")
        .agg(F.min(rank).alias("_best"), F.count("*").alias("group_size")),
        "best",
    )
    verdict = scratch.keep(
        grouped.join(best, "group").select(
            "row", "class", "group", "group_size",
            (F.col("row") == F.col("_best.row")).alias("kept"),
            F.col("_best._id").alias("keep_id"),
        ),
        "verdict",
    )
    # The texts meet all that is known of them in one join.
    return stored.join(verdict.hint("merge"), "row").select(
        "row", "_carry", "text", "class", "group", "group_size", "kept", "keep_id"
    )
