"""Packing documents into training sequences that keep to a mixture of sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from starweave.llm import text
from starweave.llm.scratch import Scratch
from starweave.llm.tokens import word_end_encoder

WINDOW = 2048
END_OF_DOCUMENT = 1

_TOKENS = (
    "part long, local long, doc_id {id}, queue string, n long, tokens binary"
)


def queue_name(source: str | None) -> str:
    """Name of a source's queue; null has one of its own."""
    return "" if source is None else f"={source}"


def phases(totals: Sequence[int], share: Sequence[float] | None) -> list[list[int]]:
    """Tokens of each queue in each phase; a phase ends when a queue runs dry.

    Without shares the queues' own totals are the mixture, and there is one phase.
    Queues without a share wait for a last phase in proportion to what they hold.
    """
    left, out = list(totals), []
    while share is not None:
        active = [i for i, n in enumerate(left) if n > 0 and share[i] > 0]
        if not active:
            break
        first = min(active, key=lambda i: left[i] / share[i])
        rounds = left[first] / share[first]
        row = [0] * len(left)
        for i in active:
            row[i] = left[i] if i == first else min(left[i], round(share[i] * rounds))
        out.append(row)
        left = [a - b for a, b in zip(left, row)]
    return out + [left] if any(left) or not out else out


@dataclass
class RoundRobin:
    """Deficit round robin over queues, with the deficits in closed form.

    In each window a queue earns credit in proportion to its tokens. It is served
    whole tokens; the fraction left over, its deficit, is carried to the next window.
    Summed up, after w windows the first queue has been served floor(w * size * share)
    tokens, the second the like share of what the first left, and so on (the largest
    queue first). So the state before any window follows from the window's number, and
    every task continues the deficits where the task before it would leave them.
    All numbers are exact integers.
    """

    queues: list[str]
    parts: list[list[int]]  # tokens by phase and queue
    window: int = WINDOW
    memory: int = 4096
    _seen: dict = field(default_factory=dict)
    _layouts: dict = field(default_factory=dict)

    def __post_init__(self):
        totals = [sum(p[i] for p in self.parts) for i in range(len(self.queues))]
        self.totals = totals
        self.total = sum(totals)
        self.rank = sorted(range(len(totals)), key=lambda i: (-totals[i], i))
        self.windows = -(-self.total // self.window)

    def served(self, w: int) -> list[int]:
        """Tokens of each queue that the first ``w`` windows hold."""
        if (out := self._seen.get(w)) is not None:
            return out
        out = [0] * len(self.totals)
        left = min(w * self.window, self.total)
        for part in self.parts:
            size = sum(part)
            take = min(left, size)
            left -= take
            for i in self.rank:
                if size and take:
                    got = take * part[i] // size
                    out[i] += got
                    take -= got
                    size -= part[i]
        if len(self._seen) >= self.memory:
            self._seen.clear()
        self._seen[w] = out
        return out

    def layout(self, w: int) -> tuple[list[int], list[int], list[int]]:
        """Of each queue in a window: first token, end, and where it is put."""
        if (out := self._layouts.get(w)) is not None:
            return out
        first, last, offset, at = self.served(w), self.served(w + 1), [], 0
        for a, b in zip(first, last):
            offset.append(at)
            at += b - a
        if len(self._layouts) >= self.memory:
            self._layouts.clear()
        self._layouts[w] = first, last, offset
        return first, last, offset

    def window_of(self, q: int, token: int, guess: int) -> int:
        """The window that holds a token of a queue."""
        lo, hi = 0, self.windows
        if 0 <= guess < self.windows:
            if self.served(guess)[q] > token:
                hi = guess
            elif self.served(guess + 1)[q] > token:
                return guess
            else:
                lo = guess + 1
        while lo + 1 < hi:
            mid = (lo + hi) // 2
            if self.served(mid)[q] <= token:
                lo = mid
            else:
                hi = mid
        return lo

    def pieces(self, q: int, start: int, n: int) -> list[tuple[int, int, int, int]]:
        """Cuts of ``n`` tokens of a queue from ``start``: first, length, window, offset."""
        out = []
        at, end = start, start + n
        w = self.window_of(q, at, at * self.windows // max(1, self.totals[q]))
        while at < end:
            first, last, offset = self._layouts.get(w) or self.layout(w)
            stop = min(end, last[q])
            if stop > at:
                out.append((at - start, stop - at, w, offset[q] + at - first[q]))
                at = stop
                w += 1
            else:  # a window without tokens of this queue
                w = self.window_of(q, at, w + 1)
        return out


def tokenized(docs: DataFrame, tokenizer: str, end: int = END_OF_DOCUMENT) -> DataFrame:
    """Ids of every document with the end mark, and its place among those of its source
    in the same task."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    mark = end.to_bytes(4, "little")

    def encode(batches):
        encoder = word_end_encoder(tokenizer)
        part, served = TaskContext.get().partitionId(), {}
        # Larger blocks look fewer pieces up.
        for batch in text.blocks(batches, "text", limit=2 * text.BLOCK_BYTES):
            local, n, queue = [], [], []
            bodies = [body or "" for body in batch.column("text").to_pylist()]
            tokens = [ids + mark for ids in encoder(bodies)]
            for ids, source in zip(tokens, batch.column("source").to_pylist()):
                name = queue_name(source)
                queue.append(name)
                n.append(len(ids) // 4)
                local.append(served.get(name, 0))
                served[name] = local[-1] + n[-1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(n), pa.int64()),
                    pa.array(local, pa.int64()),
                    batch.column("doc_id"),
                    pa.array(queue, pa.string()),
                    pa.array(n, pa.int64()),
                    pa.array(tokens, pa.binary()),
                ],
                names=["part", "local", "doc_id", "queue", "n", "tokens"],
            )

    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), "text")
    return rows.mapInArrow(encode, _TOKENS.format(id=kind))


def pack(
    docs: DataFrame,
    tokenizer: str,
    mixture: Mapping[str | None, float] | None = None,
    window: int = WINDOW,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Cut all documents into sequences of ``window`` tokens; only the last is shorter.

    Each source is a queue: its documents in stored order, each with an end mark.
    Every window takes from every queue its part of the ``mixture`` (a weight by
    source; by default the tokens that each source has, so that all run dry together), see
    ``RoundRobin``. Documents are cut where a window's part ends.

    A null or empty text is its end mark alone. Repeated rows are packed each; ids
    may be null. An empty table gives no row. Returns a row per piece: ``doc_id``,
    ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.
    """
    scratch = scratch or Scratch(docs.sparkSession, "pack")
    tokens = scratch.keep(tokenized(docs, tokenizer), "tokens")
    sums = scratch.keep(tokens.groupBy("queue", "part").agg(F.sum("n").alias("_n")), "sums")
    # One row per source.
    found = sorted((r["queue"], r["n"]) for r in sums.groupBy("queue").agg(F.sum("_n").alias("n")).collect())
    share = None
    if mixture is not None:
        weight = {queue_name(s): w for s, w in mixture.items()}
        share = [weight.get(q, 0) for q, _ in found]
    plan = RoundRobin([q for q, _ in found], phases([n for _, n in found], share), window)
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = scratch.keep(
        sums.select("queue", "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")),
        "base",
    )
    rows = tokens.join(base, ["queue", "part"]).select(
        "doc_id", "queue", "n", "tokens", (F.col("_base") + F.col("local")).alias("at")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    place = {q: i for i, q in enumerate(plan.queues)}

    def cut(batches):
        for batch in text.blocks(batches, "tokens"):
            row, pieces, crcs, sizes = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("queue", "at", "n", "tokens"))
            for i, (queue, at, n, ids) in enumerate(zip(*columns)):
                found = plan.pieces(place[queue], at, n)
                row += [i] * len(found)
                sizes += [n] * len(found)
                pieces += found
                crcs += [crc32(ids[4 * a : 4 * (a + length)]) for a, length, _, _ in found]
            cut_ = np.array(pieces, np.int64).reshape(-1, 4)
            columns = [cut_[:, 0], cut_[:, 1], crcs, sizes, cut_[:, 2], cut_[:, 3]]
            names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(v, pa.int64()) for v in columns)],
                names=["doc_id", *names],
            )

    return rows.mapInArrow(
        cut,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long,"
        " sequence_id long, offset long",
    )
