"""Templates of hosts: classes of tokens that occur alike on a host's pages, and their slots.

A token is an element with its path or a text at its path. A token that occurs the same number
of times on every page has a role for each occurrence; else all occurrences are one role. The
roles that share their occurrence vector are a class. A class is valid if its roles keep one order,
in whole rounds, and if its rounds lie in one gap of one other class and cut across none. Valid
classes nest into the template; what lies in a gap of the innermost round is a slot.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starweave.llm.scratch import Scratch

#: A host's template is deduced from this many different pages at least. Its classes occur on
#: this share of them at least, and are in order and in place on this share of those.
FEWEST_PAGES = 3
SUPPORT = 0.9

#: Kinds of what a page says of a class: a role out of order, a class that is no whole
#: rounds or cuts across a larger one, the gap that it lies in.
ROLE, CLASS, PLACE = range(3)
#: The gap of a class that no other encloses, and of one that lies in several on a page.
OUTSIDE, SCATTERED = (0, -1), (0, -2)


def ordered(ranks: list[int]) -> set[int]:
    """Indices of a longest increasing subsequence."""
    tails: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, rank in enumerate(ranks):
        k = bisect_left(tails, rank)
        before.append(at[k - 1] if k else -1)
        tails[k : k + 1] = [rank]
        at[k : k + 1] = [i]
    found, i = set(), at[-1] if at else -1
    while i >= 0:
        found.add(i)
        i = before[i]
    return found


class Template:
    """Classes of a host, made from rows (class, place on a first page, token, occurrence);
    occurrence 0 stands for all of a token's."""

    def __init__(self, roles: Iterable[tuple[int, int, int, int]], links: Iterable[tuple[int, int]] = ()):
        self.roles: dict[int, dict[int, tuple[int, int]]] = {}
        self.size: dict[int, int] = {}
        self.rounds: set[int] = set()
        self.links = set(links)
        for cls, _, token, nth in sorted(roles):
            rank = self.size.get(cls, 0)
            self.size[cls] = rank + 1
            self.roles.setdefault(token, {})[nth] = (cls, rank)
            if nth == 0:
                self.rounds.add(cls)

    def events(self, tokens: list[int], ats: list[list[int]]) -> list[tuple[int, int, int, int, int]]:
        """The page's roles in order: place, class, rank in the class, token, occurrence."""
        found = []
        for token, places in zip(tokens, ats):
            roles = self.roles.get(token)
            if roles is None:
                continue
            for k, at in enumerate(places, 1):
                nth = 0 if 0 in roles else k
                if nth in roles:
                    found.append((at, *roles[nth], token, nth))
        found.sort()
        return found

    def walk(self, tokens: list[int], ats: list[list[int]], blocks: Iterable[int] = ()):
        """What the page says of the classes, as rows (kind, class, a, b), and the slots of the
        texts at the places ``blocks``: (class, rank of the role before), or None if the text
        is the template's."""
        events = self.events(tokens, ats)
        of_class: dict[int, list[int]] = {}
        for i, event in enumerate(events):
            of_class.setdefault(event[1], []).append(i)
        faults: set[tuple[int, int, int, int]] = set()
        opens, closes, used = set(), set(), set()
        for cls, indices in of_class.items():
            ranks, size = [events[i][2] for i in indices], self.size[cls]
            if cls in self.rounds:
                if ranks != list(range(size)) * (len(ranks) // size):
                    faults.add((CLASS, cls, 0, 0))
                    continue
                used.update(indices)
                opens.update(indices[::size])
                closes.update(indices[size - 1 :: size])
            else:
                inside = ordered(ranks)
                faults.update((ROLE, cls, *events[i][3:]) for k, i in enumerate(indices) if k not in inside)
                chosen = [indices[k] for k in sorted(inside)]
                used.update(chosen)
                opens.add(chosen[0])
                closes.add(chosen[-1])

        places: dict[int, tuple[int, int]] = {}
        slots: dict[int, tuple[int, int] | None] = dict.fromkeys(e[0] for e in events)
        todo = sorted(b for b in blocks if b not in slots)[::-1]
        stack: list[list[int]] = []
        is_open: set[int] = set()
        for i, (at, cls, rank, _, _) in enumerate(events):
            top = tuple(stack[-1]) if stack else OUTSIDE
            while todo and todo[-1] < at:
                slots[todo.pop()] = top
            if i not in used:
                continue
            if i in opens:
                places[cls] = top if places.get(cls, top) == top else SCATTERED
                if i not in closes:
                    stack.append([cls, rank])
                    is_open.add(cls)
                continue
            while cls in is_open and stack[-1][0] != cls:
                # Two classes cut across each other: the smaller one is no part of the template.
                loser = min(cls, stack[-1][0], key=lambda c: (self.size[c], c))
                faults.add((CLASS, loser, 0, 0))
                stack.pop(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == loser))
                is_open.discard(loser)
            if cls in is_open:
                stack[-1][1] = rank
                if i in closes:
                    stack.pop()
                    is_open.discard(cls)
        top = tuple(stack[-1]) if stack else OUTSIDE
        slots.update((b, top) for b in todo)
        said = [*faults, *((PLACE, cls, *place) for cls, place in places.items())]
        return said, {b: slots[b] for b in blocks}


class Templates:
    """Templates of the rows of a batch; rows of a host mostly come together."""

    def __init__(self, most: int = 64):
        self.most = most
        self.made: dict[str, Template] = {}

    def __call__(self, batch: pa.RecordBatch, row: int, host: str) -> Template:
        if host not in self.made:
            if len(self.made) >= self.most:
                self.made.clear()
            lists = [
                [tuple(r.values()) for r in batch.column(c)[row].as_py() or ()] if c in batch.schema.names else ()
                for c in ("roles", "links")
            ]
            self.made[host] = Template(*lists)
        return self.made[host]


def _check(batches):
    made = Templates()
    for batch in batches:
        hosts = batch.column("host").to_pylist()
        tokens, ats = batch.column("tokens").to_pylist(), batch.column("ats").to_pylist()
        rows = []
        for i, host in enumerate(hosts):
            said, _ = made(batch, i, host).walk(tokens[i], ats[i])
            rows += [(host, *r) for r in said]
        columns = list(zip(*rows)) or [()] * 5
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "kind", "cls", "a", "b"]
        )


def _measure(batches):
    made = Templates()
    for batch in batches:
        rows = batch.select(["host", "tokens", "ats", "places", "free", "linked", "sizes"]).to_pylist()
        sums: dict[tuple[str, int, int], list[int]] = {}
        for i, r in enumerate(rows):
            _, slots = made(batch, i, r["host"]).walk(r["tokens"], r["ats"], r["places"])
            for at, free, linked, size in zip(r["places"], r["free"], r["linked"], r["sizes"]):
                if free and slots[at] is not None:
                    s = sums.setdefault((r["host"], *slots[at]), [0, 0])
                    s[0] += linked
                    s[1] += size
        columns = list(zip(*((*k, *v) for k, v in sums.items()))) or [()] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "cls", "gap", "linked", "size"]
        )


def _halves(value: Column, name: str) -> list[Column]:
    """Sums of hashes in two halves that cannot overflow."""
    return [
        F.sum(value.bitwiseAND(F.lit((1 << 31) - 1))).alias(f"{name}_low"),
        F.sum(F.shiftrightunsigned(value, 33)).alias(f"{name}_high"),
    ]


def class_roles(pages: DataFrame) -> DataFrame:
    """Roles of each host's classes, not yet tested: host, cls, seen, token, nth, at.

    A vector is known by the sums of a hash of each (page, count), so it is summed up in parts and
    no task sees a host's pages together. The order in a class is that on the page with the
    smallest body, which is the same page for all its tokens.
    """
    many = pages.groupBy("host").agg(F.count("*").alias("pages")).filter(F.col("pages") >= FEWEST_PAGES)
    each = pages.select("host", "body", F.explode(F.arrays_zip("tokens", "ats")).alias("_t")).select(
        "host", "body", F.col("_t.tokens").alias("token"), F.col("_t.ats").alias("ats"), F.size("_t.ats").alias("n")
    )
    vectors = each.groupBy("host", "token").agg(
        F.count("*").alias("seen"),
        (F.min("n") == F.max("n")).alias("even"),
        *_halves(F.xxhash64("body"), "page"),
        *_halves(F.xxhash64("body", "n"), "count"),
        F.min(F.struct("body", "ats")).alias("first"),
    )
    # Most tokens stand on few pages and need not meet their host's number of pages.
    frequent = vectors.filter(F.col("seen") >= SUPPORT * FEWEST_PAGES).join(many, "host")
    frequent = frequent.filter(F.col("seen") >= SUPPORT * F.col("pages"))
    vector = [F.when(F.col("even"), F.col(f"page_{h}")).otherwise(F.col(f"count_{h}")) for h in ("low", "high")]
    ats = F.when(F.col("even"), F.col("first.ats")).otherwise(F.slice("first.ats", 1, 1))
    return frequent.select(
        "host", F.xxhash64("host", "seen", "even", *vector).alias("cls"), "seen", "even", "token",
        F.posexplode(ats).alias("nth", "at"),
    ).withColumn("nth", F.when(F.col("even"), F.col("nth") + 1).otherwise(0)).drop("even")


def _packed(roles: DataFrame) -> DataFrame:
    """A row per host. Each role stands on most pages of its host, so a host has hardly more
    roles than a page of it has tokens."""
    return roles.groupBy(F.col("host").alias("_host")).agg(
        F.collect_list(F.struct("cls", "at", "token", "nth")).alias("roles")
    )


def templates(parsed: DataFrame, scratch: Scratch) -> DataFrame:
    """Template of each host that has one: ``_host``, ``roles``, and ``links``, its slots whose
    texts are mostly links over all the host's pages.

    ``parsed`` has host, body, tokens, their places ``ats``, and of the texts their ``places``, whether they
    are ``free`` of marks, ``linked`` characters and ``sizes``. Pages of one host with equal
    bodies count once.
    """
    columns = ["tokens", "ats", "places", "free", "linked", "sizes"]
    pages = parsed.filter("host <> ''").groupBy("host", "body").agg(F.max(F.struct(*columns)).alias("_p"))
    pages = scratch.keep(pages.select("host", "body", "_p.*"), "distinct")
    roles = scratch.keep(class_roles(pages), "roles")

    def met(which: DataFrame, *names: str) -> DataFrame:
        return pages.select("host", *names).join(_packed(which), F.col("host") == F.col("_host")).drop("_host")

    said = met(roles, "tokens", "ats").mapInArrow(_check, "host string, kind int, cls long, a long, b long")
    said = scratch.keep(said.groupBy("host", "kind", "cls", "a", "b").agg(F.count("*").alias("pages")), "said")
    late = said.filter(F.col("kind") == ROLE).select(
        "host", "cls", F.col("a").alias("token"), F.col("b").cast("int").alias("nth"), F.col("pages").alias("late")
    )
    of_class = said.filter(F.col("kind") != ROLE).groupBy("host", "cls").agg(
        F.max(F.when(F.col("kind") == CLASS, F.col("pages"))).alias("broken"),
        F.max(F.when((F.col("kind") == PLACE) & (F.col("b") != SCATTERED[1]), F.col("pages"))).alias("placed"),
    )
    enough = SUPPORT * F.col("seen")
    valid = roles.join(of_class, ["host", "cls"]).join(late, ["host", "cls", "token", "nth"], "left")
    valid = valid.filter(
        (F.col("placed") >= enough)
        & (F.col("seen") - F.coalesce("broken", F.lit(0)) >= enough)
        & (F.col("seen") - F.coalesce("late", F.lit(0)) >= enough)
    )
    valid = scratch.keep(valid.select("host", "cls", "at", "token", "nth"), "valid")
    slots = met(valid, *columns).mapInArrow(_measure, "host string, cls long, gap long, linked long, size long")
    slots = slots.groupBy("host", "cls", "gap").agg(F.sum("linked").alias("linked"), F.sum("size").alias("size"))
    links = slots.filter(2 * F.col("linked") > F.col("size")).groupBy(F.col("host").alias("_host")).agg(
        F.collect_list(F.struct("cls", "gap")).alias("links")
    )
    return scratch.keep(_packed(valid).join(links, "_host", "left"), "templates")
