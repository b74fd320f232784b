"""Mixing sources to target weights, in fixed-length blocks of words."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from starweave.llm import text
from starweave.llm.scratch import Scratch

BLOCK_WORDS = 512
SHARD_BLOCKS = 1024
WORD = r"[^\x20\x09-\x0D]+"
#: Documented layout of monotonically_increasing_id: the task is above the low 33 bits.
ROW_BITS = 33


def shares(
    sizes: Sequence[int], weights: Sequence[float] = (5, 2, 1), total: float = 1.5, cap: float = 2.0
) -> list[float]:
    """Target size of each source, the sources being in their order.

    ``total`` times all sizes is shared by the weights, which repeat. A target stops
    at ``cap`` times its source's size; the excess is shared anew by weight among the
    others until none is above.
    """
    weight = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    target = [0.0] * len(sizes)
    left, active = total * sum(sizes), set(range(len(sizes)))
    while active:
        whole = sum(weight[i] for i in active)
        asked = {i: left * weight[i] / whole for i in active}
        above = [i for i in active if asked[i] > cap * sizes[i]]
        if not above:
            for i in active:
                target[i] = asked[i]
            break
        for i in above:
            target[i] = cap * sizes[i]
            left -= target[i]
            active.discard(i)
    return target


class Permutation:
    """A pseudorandom permutation of 0..n-1: a Feistel network with cycle walking."""

    ROUNDS = 4

    def __init__(self, n: int, seed: int):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = text.seeded(self.ROUNDS, seed)

    def _walk(self, index, keys, swap: bool) -> np.ndarray:
        x = np.atleast_1d(np.asarray(index, dtype=np.uint64)).copy()
        todo = np.arange(len(x))
        while len(todo):
            left, right = x[todo] >> self.half, x[todo] & self.mask
            if swap:
                left, right = right, left
            for key in keys:
                left, right = right, left ^ (text.mix(right ^ key) & self.mask)
            if swap:
                left, right = right, left
            x[todo] = (left << self.half) | right
            todo = todo[x[todo] >= self.n]
        return x.astype(np.int64)

    def __call__(self, index) -> np.ndarray:
        return self._walk(index, self.keys, swap=False)

    def inverse(self, index) -> np.ndarray:
        return self._walk(index, self.keys[::-1], swap=True)


@dataclass(frozen=True)
class Draw:
    """How many words of each source the mix takes, as slots that hold a block each.

    Slot i of a source is in round i // blocks of that source and names the block at
    place i % blocks of the round's permutation. The last slot may be cut short, so a
    source gives its target to the word.
    """

    sizes: tuple[int, ...]
    wanted: tuple[int, ...]
    seed: int = 0
    block: int = BLOCK_WORDS
    shard: int = SHARD_BLOCKS

    def blocks(self, s: int) -> int:
        return -(-self.sizes[s] // self.block)

    def order(self, s: int, epoch: int) -> Permutation:
        return Permutation(self.blocks(s), (self.seed * 1_000_003 + s) * 1009 + epoch)

    def slots(self, s: int) -> tuple[int, int]:
        """Number of slots of source ``s`` and the words that its last one leaves out."""
        size, want, n = self.sizes[s], self.wanted[s], self.blocks(s)
        if not size or not want:
            return 0, 0
        epoch, rest = divmod(want, size)
        if not rest:
            return epoch * n, 0
        missing = n * self.block - size  # of the source's last block
        short = int(self.order(s, epoch).inverse(n - 1)[0])
        t = -(-rest // self.block)
        if short < t:
            t = -(-(rest + missing) // self.block)
        return epoch * n + t, t * self.block - missing * (short < t) - rest

    def counts(self, lo: int, hi: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of the shards from ``lo`` to ``hi``: number, first slot and slots by source.

        Shard counts are multinomial draws from what is left of each source, made top
        down: a range of shards is halved, the left half draws from the range's
        slots. So they add up to the slots of each source, and any range of shards is
        drawn without the others.
        """
        totals = np.array([self.slots(s)[0] for s in range(len(self.sizes))], np.int64)

        def descend(a: int, b: int, before: np.ndarray, have: np.ndarray):
            if b <= lo or a >= hi:
                return
            if b - a == 1:
                yield a, before, have
                return
            mid = (a + b) // 2
            left = self.split(have, (mid - a) * self.shard, (a, b))
            yield from descend(a, mid, before, left)
            yield from descend(mid, b, before + left, have - left)

        if totals.sum():
            yield from descend(0, self.n_shards, np.zeros_like(totals), totals)

    @property
    def n_shards(self) -> int:
        return -(-sum(self.slots(s)[0] for s in range(len(self.sizes))) // self.shard)

    def split(self, have: np.ndarray, n: int, node: tuple[int, int]) -> np.ndarray:
        rng = np.random.default_rng([self.seed, *node])
        drawn = np.minimum(rng.multinomial(n, have / have.sum()), have)
        while (lacking := n - int(drawn.sum())) > 0:  # a source was overdrawn
            room = have - drawn
            more = np.minimum(rng.multinomial(lacking, room / room.sum()), room)
            drawn = drawn + more
        return drawn


def word_places(
    docs: DataFrame, scratch: Scratch, carry: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Rows with their size in words and their place in the word stream of their source,
    and the same rows with the ``carry`` columns.

    A source's stream is its documents in the order of the stored rows. The places
    are sums within each (source, task of the scan) plus the sum of the tasks before;
    no task sees a whole source.
    """
    sized = scratch.keep(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("source").cast("string").alias("source"),
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
            F.struct(*(F.col(f"`{c}`") for c in carry)).alias("_carry"),
        ),
        "sized",
    )
    part = F.shiftrightunsigned("row", ROW_BITS).alias("part")
    inner = Window.partitionBy("source", "part").orderBy("row")
    narrow = sized.select("row", "source", "size", part)
    within = narrow.withColumn("start", F.sum("size").over(inner) - F.col("size"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        narrow.groupBy("source", "part")
        .agg(F.sum("size").alias("_size"))
        .select(
            F.col("source").alias("_source"),
            F.col("part").alias("_part"),
            F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base"),
        )
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part"))
    places = within.join(scratch.keep(base, "base"), same).select(
        "row", "source", "size", (F.col("start") + F.col("_base")).alias("start")
    )
    return scratch.keep(places, "places"), sized


def source_targets(places: DataFrame, **options) -> list[tuple[str | None, int, float]]:
    """Source, size and target, in code point order with null last: a row per source."""
    found = places.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found = sorted(found, key=lambda r: (r["source"] is None, r["source"] or ""))
    target = shares([r["size"] for r in found], **options)
    return [(r["source"], r["size"], t) for r, t in zip(found, target)]


def block_plan(spark: SparkSession, draw: Draw) -> DataFrame:
    """Slots of the mix as rows: ``s``, ``block``, ``epoch`` and ``take`` (words)."""
    ends = [draw.slots(s) for s in range(len(draw.sizes))]

    def plan(batches):
        for batch in batches:
            ids = batch.column("id").to_pylist()
            if not ids:
                continue
            for shard, first, n in draw.counts(ids[0], ids[-1] + 1):
                for s in np.flatnonzero(n):
                    slot = np.arange(first[s], first[s] + n[s])
                    blocks = draw.blocks(s)
                    epoch, place = np.divmod(slot, blocks)
                    block = np.empty(len(slot), np.int64)
                    for e in np.unique(epoch):
                        block[epoch == e] = draw.order(s, int(e))(place[epoch == e])
                    size = np.minimum(draw.block, draw.sizes[s] - block * draw.block)
                    size = np.where(slot == ends[s][0] - 1, size - ends[s][1], size)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(slot), shard), pa.int64()),
                            pa.array(np.full(len(slot), s), pa.int32()),
                            pa.array(block, pa.int64()),
                            pa.array(epoch, pa.int32()),
                            pa.array(size, pa.int64()),
                        ],
                        names=["shard", "s", "block", "epoch", "take"],
                    )

    parts = max(1, min(draw.n_shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark.range(0, draw.n_shards, 1, parts).mapInArrow(
        plan, "shard long, s int, block long, epoch int, take long"
    )


def mixed_pieces(
    docs: DataFrame, scratch: Scratch, seed: int = 0, carry: Sequence[str] = (), **options
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Places of the rows, their carried columns, the sources, and the pieces taken.

    A piece is a run of words of a row (``word``: first word, ``n``: words) that the
    mix takes in round ``epoch`` of its source. Rows and slots meet by (source, block).
    """
    spark = docs.sparkSession
    places, sized = word_places(docs, scratch, carry)
    found = source_targets(places, **options)
    draw = Draw(tuple(r[1] for r in found), tuple(round(r[2]) for r in found), seed)
    sources = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(found)],
        "s int, _source string, source_size long, target double",
    )
    b = F.lit(draw.block)
    covered = F.sequence(F.expr(f"start div {draw.block}"), F.expr(f"(start + size - 1) div {draw.block}"))
    cut = (
        places.filter("size > 0")
        .join(sources, F.col("source").eqNullSafe(F.col("_source")))
        .select("row", "s", "start", "size", F.explode(covered).alias("block"))
        .select(
            "row", "s", "block", "start",
            F.greatest("start", F.col("block") * b).alias("lo"),
            F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * b).alias("hi"),
        )
    )
    n = F.least("hi", F.col("block") * b + F.col("take")) - F.col("lo")
    slots = block_plan(spark, draw)
    # The slots grow with the corpus, which Spark cannot see in the range that they come from.
    pieces = cut.join(slots.hint("merge"), ["s", "block"]).select(
        "row", "epoch", (F.col("lo") - F.col("start")).alias("word"), n.alias("n")
    )
    return places, sized, sources, pieces.filter("n > 0")


def mix_counts(docs: DataFrame, seed: int = 0, scratch: Scratch | None = None, **options) -> DataFrame:
    """Words that the mix takes of every document.

    A null text or one without words has size 0 and is never taken. Null is a source
    of its own, ordered last. Repeated rows are documents of their own; ``doc_id``
    may be null. The same rows and seed give the same result. Returns ``doc_id``,
    ``size``, ``source_size``, ``target`` (its source's) and ``taken``.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mix")
    places, sized, sources, pieces = mixed_pieces(docs, scratch, seed, ["doc_id"], **options)
    taken = pieces.groupBy("row").agg(F.sum("n").alias("taken"))
    return (
        sized.join(taken, "row", "left")
        .join(sources, F.col("source").eqNullSafe(F.col("_source")))
        .select(
            "_carry.doc_id", "size", "source_size", "target",
            F.coalesce("taken", F.lit(0)).alias("taken"),
        )
    )


def _cut_words(batches):
    """Texts reduced to their taken runs of words; runs that touch are one piece."""
    for batch in text.blocks(batches, "text"):
        out = []
        runs = batch.column("runs").to_pylist()
        whole = batch.column("whole").to_pylist()
        for body, all_, run in zip(text.encoded(batch.column("text")), whole, runs):
            if not all_:
                w = text.words([body])
                merged: list[list[int]] = []
                for r in sorted(run, key=lambda r: r["word"]):
                    if merged and merged[-1][1] == r["word"]:
                        merged[-1][1] += r["n"]
                    else:
                        merged.append([r["word"], r["word"] + r["n"]])
                body = b"\n".join(body[w.start[a] : w.end[z - 1]] for a, z in merged)
            out.append(body.decode("utf-8"))
        names = [n for n in batch.schema.names if n not in ("runs", "whole", "text")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(out, pa.string())], names=[*names, "text"]
        )


def mix_documents(docs: DataFrame, seed: int = 0, scratch: Scratch | None = None, **options) -> DataFrame:
    """The mix itself: documents as often as they are taken, cut to the taken words.

    A row per document and round of its source in which words of it are taken: the
    whole text if all are, else the taken runs of words, joined by line ends. Rows of
    documents that the mix does not take are gone. Columns are those of ``docs``;
    ``n_chars``, if there, is the new text's.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mix-docs")
    carry = docs.columns
    _, sized, _, pieces = mixed_pieces(docs, scratch, seed, carry, **options)
    runs = pieces.groupBy("row", "epoch").agg(
        F.sum("n").alias("_n"), F.collect_list(F.struct("word", "n")).alias("runs")
    )
    rest = [c for c in carry if c != "text"]
    # About as many runs as rows: not a side to broadcast.
    rows = sized.join(scratch.keep(runs, "runs").hint("merge"), "row").select(
        F.struct(*(F.col(f"_carry.`{c}`") for c in rest)).alias("_rest"),
        F.col("_carry.text").alias("text"),
        (F.col("_n") == F.col("size")).alias("whole"),
        "runs",
    )
    kind = rows.schema["_rest"].dataType.simpleString()
    cut = rows.mapInArrow(_cut_words, f"_rest {kind}, text string")
    columns = {c: F.col("text") if c == "text" else F.col(f"_rest.`{c}`") for c in carry}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.select(*(c.alias(n) for n, c in columns.items()))
