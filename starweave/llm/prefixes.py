"""The prefix trie of rebuilt conversations, by composable fingerprints of their prefixes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starweave.llm import text
from starweave.llm.scratch import Scratch

#: A turn is a pair of affine maps x -> a x + b modulo this prime, which is below 2^31: so no
#: product leaves 63 bits. A sequence is the product of its turns' maps.
PRIME = (1 << 31) - 1
#: Conversations start from the base conversation of their ``FAMILY``; heads have less than
#: ``HEADS`` turns.
FAMILY, HEADS = 5, 9
#: Depths that a running sum covers in one go; a longer conversation has several such chunks.
CHUNK = 4096
#: Fingerprints that do not tell turns or prefixes apart are replaced, so many times.
TRIES = 4

# A map is packed into one long, a above b. The map that changes nothing:
_SHIFT = 31
IDENTITY = 1 << _SHIFT
NODE = ("depth", "f1", "f2")


def composed(f: Column, g: Column) -> Column:
    """The product of two packed maps: g first, then f."""
    low = F.lit(PRIME).cast("long")
    a, b = F.shiftright(f, _SHIFT), f.bitwiseAND(low)
    c, d = F.shiftright(g, _SHIFT), g.bitwiseAND(low)
    return F.shiftleft(F.pmod(a * c, low), _SHIFT).bitwiseOR(F.pmod(a * d + b, low))


def maps(t1: np.ndarray, t2: np.ndarray) -> tuple[list[int], list[int], list[int], list[int]]:
    """The two maps of each turn from its two hashes: a, b, a', b'."""
    one, two = text.mix(t1.view(np.uint64)), text.mix(t2.view(np.uint64))
    p = np.uint64(PRIME)
    half = np.uint64(32)
    low = np.uint64(0xFFFFFFFF)
    return (
        ((one & low) % (p - np.uint64(1)) + np.uint64(1)).tolist(),
        ((one >> half) % p).tolist(),
        ((two & low) % (p - np.uint64(1)) + np.uint64(1)).tolist(),
        ((two >> half) % p).tolist(),
    )


def inverse(f: np.ndarray) -> np.ndarray:
    """The inverses of packed maps: x -> (x - b) / a."""
    a, b = f >> _SHIFT, f & PRIME
    out, base, power = np.ones_like(a), a.copy(), PRIME - 2
    while power:
        if power & 1:
            out = out * base % PRIME
        base, power = base * base % PRIME, power >> 1
    return out << _SHIFT | (PRIME - b) % PRIME * out % PRIME


def _pack(a, b) -> pa.Array:
    return pa.array(np.array(a, np.int64) << _SHIFT | np.array(b, np.int64))


def _products(batches):
    """Running products of each conversation's turns, in sorted order, as far as they lie in
    this task: ``f`` with the turn itself, ``g`` without it. The state is one pair of maps."""
    conv, at = None, 0
    a1, b1, a2, b2 = 1, 0, 1, 0
    for batch in batches:
        out: list[list[int]] = [[] for _ in range(9)]
        turn = maps(batch.column("t1").to_numpy(), batch.column("t2").to_numpy())
        for name, c1, d1, c2, d2 in zip(batch.column("conv").to_pylist(), *turn):
            if name != conv:
                conv, at = name, 0
                a1, b1, a2, b2 = 1, 0, 1, 0
            before = a1, b1, a2, b2
            b1, a1 = (a1 * d1 + b1) % PRIME, a1 * c1 % PRIME
            b2, a2 = (a2 * d2 + b2) % PRIME, a2 * c2 % PRIME
            for column, value in zip(out, (at, a1, b1, a2, b2, *before)):
                column.append(value)
            at += 1
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("conv", "t1", "t2", "bytes")),
                pa.array(out[0], pa.int64()),
                *(_pack(out[i], out[i + 1]) for i in (1, 3, 5, 7)),
            ],
            names=["conv", "t1", "t2", "bytes", "at", "f1", "f2", "g1", "g2"],
        )


def _begins(batches):
    """Of each task's piece of a conversation that several tasks have: the turns before it
    and their product. There are at most two such pieces for each task."""
    pack = lambda f, g: _composed(f, g)
    for batch in batches:
        rows = []
        for conv, pieces in zip(batch.column("conv").to_pylist(), batch.column("pieces").to_pylist()):
            before, s1, s2 = 0, IDENTITY, IDENTITY
            for piece in sorted(pieces, key=lambda p: p["part"]):
                rows.append((conv, piece["part"], before, s1, s2))
                before += piece["n"]
                s1, s2 = pack(s1, piece["f1"]), pack(s2, piece["f2"])
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["conv", "part", "before", "s1", "s2"]
        )


def _composed(f: int, g: int) -> int:
    a, b, c, d = f >> _SHIFT, f & PRIME, g >> _SHIFT, g & PRIME
    return a * c % PRIME << _SHIFT | (a * d + b) % PRIME


def paths(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """Turns with their place in their conversation (``pos``, from 0) and the products of the
    conversation up to (``f1``, ``f2``) and before (``g1``, ``g2``) them.

    Rows are sorted by ranges of conversation, turn and row, so that a conversation
    that holds a third of all rows is several tasks' work. Each task takes the products of
    its piece; as maps compose, the pieces before it come in as one more product.
    """
    ranged = turns.repartitionByRange("conv", "turn", "t1", "t2", "row").sortWithinPartitions(
        "conv", F.asc_nulls_first("turn"), "t1", "t2", "row"
    )
    scan = ranged.select("conv", "t1", "t2", "bytes").mapInArrow(
        _products, "conv long, t1 long, t2 long, bytes long, at long, f1 long, f2 long, g1 long, g2 long"
    )
    scan = scratch.keep(scan.withColumn("part", F.spark_partition_id().cast("long")), "scan")
    piece = scan.groupBy("conv", "part").agg(
        F.count("*").alias("n"), F.max_by(F.struct("f1", "f2"), "at").alias("_f")
    )
    several = (
        piece.groupBy("conv")
        .agg(F.count("*").alias("k"), F.collect_list(F.struct("part", "n", "_f.f1", "_f.f2")).alias("pieces"))
        .filter("k > 1")
    )
    begins = scratch.keep(
        several.select("conv", "pieces").mapInArrow(_begins, "conv long, part long, before long, s1 long, s2 long"),
        "begins",
    )
    # At most two rows for each task of the sort.
    joined = scan.join(F.broadcast(begins), ["conv", "part"], "left")
    begun = F.col("before").isNotNull()
    return scratch.keep(
        joined.select(
            "conv", "t1", "t2", "bytes",
            (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"),
            *(
                F.when(begun, composed(F.col(s), F.col(c))).otherwise(F.col(c)).alias(c)
                for c, s in (("f1", "s1"), ("f2", "s2"), ("g1", "s1"), ("g2", "s2"))
            ),
        ),
        "paths",
    )


def rebuilds(path: DataFrame, scratch: Scratch) -> DataFrame:
    """Of each conversation: ``base``, ``own`` (own turns that go), ``head`` (turns of the base
    that come instead), ``length`` of the rebuilt one, and the map ``m1``, ``m2`` that takes
    the product of its own turns to that of the rebuilt ones: the base head's product times
    the inverse of the product of the turns that go."""
    sizes = path.groupBy("conv").agg(F.count("*").alias("size"))
    checksum = F.crc32(F.col("conv").cast("string").cast("binary"))
    named = sizes.select(
        "conv", "size", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), (checksum % HEADS).alias("h")
    )
    base = sizes.select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    convs = named.join(base, "base", "left").select(
        "conv", "base", "h", "size",
        F.least("h", "size").alias("own"),
        F.least("h", F.coalesce("base_size", F.lit(0))).alias("head"),
    )

    def inverted(batches):
        for batch in batches:
            backs = [pa.array(inverse(batch.column(c).to_numpy())) for c in ("f1", "f2")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *backs], names=[*batch.schema.names, "i1", "i2"]
            )

    heads = path.filter(F.col("pos") < HEADS - 1).select("conv", (F.col("pos") + 1).alias("k"), "f1", "f2")
    heads = scratch.keep(
        heads.mapInArrow(inverted, "conv long, k long, f1 long, f2 long, i1 long, i2 long"), "heads"
    )
    of_base = heads.select(F.col("conv").alias("base"), F.col("k").alias("head"), "f1", "f2")
    of_own = heads.select("conv", F.col("k").alias("own"), "i1", "i2")
    same = F.lit(IDENTITY).cast("long")
    full = convs.join(of_base, ["base", "head"], "left").join(of_own, ["conv", "own"], "left")
    return scratch.keep(
        full.select(
            "conv", "base", "own", "head",
            (F.col("head") + F.col("size") - F.col("own")).alias("length"),
            *(
                composed(F.coalesce(f, same), F.coalesce(i, same)).alias(m)
                for m, f, i in (("m1", "f1", "i1"), ("m2", "f2", "i2"))
            ),
        ),
        "rebuilds",
    )


def prefix_rows(path: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """A row for each rebuilt conversation and depth: the prefix's fingerprint, that of the
    prefix before, the last turn's hashes and bytes, and the ``length`` of the whole."""
    same = F.lit(IDENTITY).cast("long")
    zero = F.lit(0).cast("long")
    root = rebuilt.select(
        "conv", zero.alias("depth"), same.alias("f1"), same.alias("f2"), same.alias("g1"), same.alias("g2"),
        zero.alias("t1"), zero.alias("t2"), zero.alias("bytes"), "length",
    )
    turns = path.filter(F.col("pos") < HEADS - 1).withColumnRenamed("conv", "base")
    head = turns.join(rebuilt.select("conv", "base", "head", "length"), "base").filter("pos < head")
    own = path.join(rebuilt, "conv").filter("pos >= own")
    return (
        root.unionAll(
            head.select("conv", F.col("pos") + 1, "f1", "f2", "g1", "g2", "t1", "t2", "bytes", "length")
        )
    ).unionAll(
        own.select(
            "conv", F.col("head") + F.col("pos") - F.col("own") + 1,
            *(composed(F.col(m), F.col(c)) for c, m in (("f1", "m1"), ("f2", "m2"), ("g1", "m1"), ("g2", "m2"))),
            "t1", "t2", "bytes", "length",
        )
    )


def _digests(batches):
    """SHA-256 of the ids of each node's conversations, in order, without holding them."""
    node, state = None, None
    for batch in batches:
        out = []
        ids = batch.column("conv").to_pylist()
        for key, conv in zip(zip(*(batch.column(c).to_pylist() for c in NODE)), ids):
            if key == node:
                state.update(b",%d" % conv)
                continue
            if node is not None:
                out.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(b"%d" % conv)
        yield _named(out)
    if node is not None:
        yield _named([(*node, state.hexdigest())])


def _named(rows: list[tuple[int, int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*NODE, "ends_sha256"])


def _turns(conversations: DataFrame, salt: int, scratch: Scratch) -> DataFrame | None:
    """Turns with two hashes of role and text, or None if they do not tell turns apart.

    Of each pair of hashes the lowest and the highest turn are compared, so equal hashes
    stand for equal turns in all that follows.
    """
    role, body = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    told = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), body.alias("text"),
        F.xxhash64(F.lit(2 * salt), role, body).alias("t1"),
        F.xxhash64(F.lit(2 * salt + 1), body, role).alias("t2"),
    )
    each = told.groupBy("t1", "t2").agg(
        F.min(F.struct("role", "text")).alias("low"), F.max(F.struct("role", "text")).alias("high")
    )
    if not each.filter("low <> high").isEmpty():
        return None
    return scratch.keep(
        told.select(
            "conv", "turn", "t1", "t2", F.octet_length("text").cast("long").alias("bytes"),
            F.monotonically_increasing_id().alias("row"),
        ),
        f"turns-{salt}",
    )


def prefix_trie(conversations: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations.

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``. Turns are ordered by
    ``turn``, null first; turns of one number by their hashes, so repeated rows are turns of
    their own. A null role or text is empty, rows with a null ``conv_id`` belong to no
    conversation and are left out. A rebuilt conversation without turns is at the root. An empty
    table has no node. Further columns are ignored.

    No rebuilt text is made: a turn is an affine map, a prefix the product of its turns'
    maps. That of a rebuilt prefix is composed of the base head's product, the inverse of the
    product of the own turns that go, and the own product so far. Rows of one fingerprint and
    depth are a node; that all of them have the same last turn and the same node before it
    is checked (by the turns' hashes, which stand for equal turns), so nodes are equal by more than
    a fingerprint. Hashes or fingerprints that fail a check are drawn anew.

    Sums over subtrees need no rounds: a node belongs to the smallest of its
    conversations, which also goes through all nodes above it. So a running sum from the end
    of each conversation, of what belongs to it, summed over a node's conversations, is the
    sum over its subtree.

    Returns ``depth``, ``f1``, ``f2`` (the node's fingerprint), ``conv_id``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256`` (null where no
    conversation ends).
    """
    scratch = scratch or Scratch(conversations.sparkSession, "prefixes")
    for salt in range(TRIES):
        turns = _turns(conversations, salt, scratch)
        if turns is None:
            continue
        tries = Scratch(conversations.sparkSession, f"prefixes-{salt}")
        path = paths(turns, tries)
        rows = tries.keep(prefix_rows(path, rebuilds(path, tries)), "rows")
        same = ("t1", "t2", "g1", "g2")
        nodes = tries.keep(
            rows.groupBy(*NODE).agg(
                F.min("conv").alias("conv_id"),
                F.count("*").alias("n_convs"),
                (F.max("length") == F.col("depth")).alias("leaf"),
                *(F.min(c).alias(c) for c in same),
                *(F.max(c).alias(f"{c}_") for c in same),
            ),
            "nodes",
        )
        if nodes.filter(" OR ".join(f"{c} <> {c}_" for c in same)).isEmpty():
            return _with_sums(rows, nodes, tries)
    raise ValueError("fingerprints do not tell turns or prefixes apart")


def _with_sums(rows: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    known = rows.select(*NODE, "conv", "bytes").join(nodes.select(*NODE, "conv_id", "n_convs", "leaf"), list(NODE))
    mine = F.col("conv") == F.col("conv_id")
    chunked = scratch.keep(
        known.select(
            *NODE, "conv", F.expr(f"depth div {CHUNK}").alias("chunk"),
            F.when(mine & F.col("leaf"), 1).otherwise(0).cast("long").alias("leaves"),
            F.when(mine, (F.col("n_convs") - 1) * F.col("bytes")).otherwise(0).cast("long").alias("saved"),
        ),
        "chunked",
    )
    sums = ("leaves", "saved")
    later = Window.partitionBy("conv").orderBy(F.col("chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    after = (
        chunked.groupBy("conv", "chunk")
        .agg(*(F.sum(c).alias(c) for c in sums))
        .select("conv", "chunk", *(F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_after") for c in sums))
    )
    within = Window.partitionBy("conv", "chunk").orderBy(F.col("depth").desc())
    running = chunked.select(*NODE, "conv", "chunk", *(F.sum(c).over(within).alias(c) for c in sums))
    whole = running.join(after.hint("merge"), ["conv", "chunk"]).select(
        *NODE, *((F.col(c) + F.col(f"{c}_after")).alias(c) for c in sums)
    )
    totals = whole.groupBy(*NODE).agg(*(F.sum(c).alias(c) for c in sums))
    children = (
        nodes.filter("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("g1").alias("f1"), F.col("g2").alias("f2"))
        .agg(F.count("*").alias("n_children"))
    )
    # A node's ids in order are one stream: in one task, but never held.
    ends = (
        rows.filter("depth = length")
        .select(*NODE, "conv")
        .repartition(*NODE)
        .sortWithinPartitions(*NODE, "conv")
        .mapInArrow(_digests, "depth long, f1 long, f2 long, ends_sha256 string")
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("f1").alias("g1"), F.col("f2").alias("g2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return (
        nodes.join(totals, list(NODE))
        .join(children, list(NODE), "left")
        .join(ends, list(NODE), "left")
        .join(parents, ["depth", "g1", "g2"], "left")
        .select(
            *NODE, "conv_id", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256",
        )
    )
