"""Licence scans with a generalised suffix automaton of licence tokens."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starweave.llm import text
from starweave.llm.licence_texts import TEMPLATES

#: Words are runs of digits, small letters and bytes beyond ASCII, after lower-casing A-Z.
WORD = text.byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8).tobytes()

#: Phrases whose places are always counted, with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: A match of so many words in a row is evidence; matches chain across gaps of up to so
#: many words, and a chain of so many words, or of this share of a template, is a label.
LONG_MATCH = 6
GAP = 40
CHAIN_WORDS = 14
CHAIN_SHARE = 0.5


@dataclass
class Automaton:
    """Suffix automaton of several sequences of symbols.

    Reading a text symbol by symbol gives its matching statistics: at each symbol the
    length of the longest run that ends there and occurs in a sequence, with the state
    that stands for it. ``places`` has the (sequence, end) pairs of the long runs.
    """

    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    places: dict[int, list[tuple[int, int]]] = field(default_factory=dict)

    @classmethod
    def of(cls, sequences: list[list[int]], least: int) -> Automaton:
        made = cls()
        ends: dict[int, list[tuple[int, int]]] = {}
        for s, sequence in enumerate(sequences):
            last = 0
            for i, symbol in enumerate(sequence):
                last = made._extend(last, symbol)
                ends.setdefault(last, []).append((s, i + 1))
        # Every suffix of a run that ends at a place ends there as well.
        for state in sorted(range(len(made.length)), key=made.length.__getitem__, reverse=True):
            if made.length[state] < least:
                break
            own = sorted(set(ends.get(state, ())))
            made.places[state] = own
            if made.link[state] > 0:
                ends.setdefault(made.link[state], []).extend(own)
        return made

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, symbol: int) -> int:
        """The state of the run of ``state`` and ``symbol``, on its own."""
        old = self.step[state][symbol]
        if self.length[old] == self.length[state] + 1:
            return old
        copy = self._new(self.length[state] + 1, dict(self.step[old]), self.link[old])
        self.link[old] = copy
        while state >= 0 and self.step[state].get(symbol) == old:
            self.step[state][symbol] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.step[last]:
            return self._split(last, symbol)
        new = self._new(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and symbol not in self.step[state]:
            self.step[state][symbol] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, symbol)
        return new

    def read(self, symbols: list[int]):
        """Matching statistics: state and length of the match at each symbol."""
        state = size = 0
        for symbol in symbols:
            while state and symbol not in self.step[state]:
                state = self.link[state]
                size = self.length[state]
            if symbol in self.step[state]:
                state = self.step[state][symbol]
                size += 1
            else:
                state = size = 0
            yield state, size


@dataclass(frozen=True)
class Span:
    """A chain of matches with one template: words ``start`` to ``end`` of a text."""

    label: str
    template: int
    start: int
    end: int
    covered: int
    share: float


def chains(matches: list[tuple[int, int, int, int]], sizes: list[int], gap: int = GAP):
    """Chains of matches (template, start in template, start in text, length).

    A match follows another of its template if it is later in both, by at most ``gap``
    words. Of a template's chains those with the most words win, each match being in
    one. Yields template, start and end in the text, and template words covered.
    """
    by: dict[int, list[tuple[int, int, int]]] = {}
    for t, i, j, n in matches:
        by.setdefault(t, []).append((j, i, n))
    for t, found in by.items():
        found.sort()
        best: list[int] = []
        back: list[int] = []
        for k, (j, i, n) in enumerate(found):
            top, before = 0, -1
            for h in range(k - 1, -1, -1):
                j2, i2, n2 = found[h]
                if j - j2 > gap + sizes[t]:
                    break
                over = max(0, j2 + n2 - j, i2 + n2 - i)
                near = j - (j2 + n2) <= gap and i - (i2 + n2) <= gap
                if j2 < j and i2 < i and near and over < n and best[h] - over > top:
                    top, before = best[h] - over, h
            best.append(top + n)
            back.append(before)
        used = [False] * len(found)
        for k in sorted(range(len(found)), key=lambda k: (-best[k], k)):
            if used[k]:
                continue
            covered, h, first = 0, k, k
            while h >= 0 and not used[h]:
                used[h] = True
                first, h = h, back[h]
            covered = best[k] - (best[h] if h >= 0 else 0)
            yield t, found[first][0], max(found[k][0] + found[k][2], 0), min(covered, sizes[t])


class Scanner:
    """Finds templates and phrases in the words of a block of texts."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]] = TEMPLATES):
        bodies = [(label, body) for label, all_ in sorted(templates.items()) for body in all_]
        lower = [body.encode().translate(_LOWER) for _, body in bodies]
        w = text.words(lower, WORD)
        self.labels = [label for label, _ in bodies]
        self.known, symbol = np.unique(w.hash, return_inverse=True)
        sequences = [symbol[a:b].tolist() for a, b in zip(w.first, w.first[1:])]
        self.sizes = [len(s) for s in sequences]
        self.automaton = Automaton.of(sequences, LONG_MATCH)
        self.phrases = []
        for phrase, label in PHRASES:
            self.phrases.append((text.words([phrase.encode()], WORD).hash, label))

    def base(self, w: text.Words) -> list[list[tuple[int, str]]]:
        """Of each text, first word and label of the places where a phrase stands."""
        out: list[list[tuple[int, str]]] = [[] for _ in range(w.n_docs)]
        for hashes, label in self.phrases:
            n = len(hashes)
            if len(w.start) < n:
                continue
            hit = w.doc[: len(w.doc) - n + 1] == w.doc[n - 1 :]
            for k, h in enumerate(hashes):
                hit = hit & (w.hash[k : len(w.hash) - n + 1 + k] == h)
            for at in np.flatnonzero(hit).tolist():
                d = int(w.doc[at])
                out[d].append((at - int(w.first[d]), label))
        return out

    def spans(self, w: text.Words) -> list[list[Span]]:
        """Of each text, the chains that are long enough."""
        out: list[list[Span]] = [[] for _ in range(w.n_docs)]
        at = np.searchsorted(self.known, w.hash)
        at = np.minimum(at, len(self.known) - 1)
        known = self.known[at] == w.hash
        # Only runs of known words can hold a long match.
        edge = np.ones(len(known) + 1, bool)
        if len(known):
            edge[1:-1] = (known[1:] != known[:-1]) | (w.doc[1:] != w.doc[:-1])
        begin = np.flatnonzero(edge[:-1])
        end = np.flatnonzero(edge[1:]) + 1
        runs = known[begin] & (end - begin >= LONG_MATCH) if len(begin) else np.empty(0, bool)
        matches: dict[int, list[tuple[int, int, int, int]]] = {}
        for a, b in zip(begin[runs].tolist(), end[runs].tolist()):
            d = int(w.doc[a])
            base = a - int(w.first[d])
            last = (0, 0)
            for i, now in enumerate([*self.automaton.read(at[a:b].tolist()), (0, 0)]):
                # A match ends where the next word does not lengthen it.
                state, n = last
                if n >= LONG_MATCH and now[1] <= n:
                    for t, stop in self._places(state, n):
                        matches.setdefault(d, []).append((t, stop - n, base + i - n, n))
                last = now
        for d, found in matches.items():
            for t, start, stop, covered in chains(found, self.sizes):
                share = covered / self.sizes[t]
                if covered >= CHAIN_WORDS or share >= CHAIN_SHARE:
                    out[d].append(Span(self.labels[t], t, start, stop, covered, share))
        return out

    def _places(self, state: int, n: int) -> list[tuple[int, int]]:
        return self.automaton.places.get(state, [])


def scan(docs: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """All rows as ``_row`` with what their whole texts hold of licences.

    ``n_words``; ``places`` (first word and label of each phrase), ``spans`` (label,
    first word, end, covered words and share of the template of each chain). The small
    automaton is made in every task. A null text counts as empty; equal texts have equal
    results.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("_row"),
        F.col("text").cast("string").alias("text"),
    )

    def run(batches):
        scanner = Scanner(templates)
        place = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
        span = pa.list_(
            pa.struct(
                [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                 ("covered", pa.int64()), ("share", pa.float64())]
            )
        )
        for batch in text.blocks(batches, "text"):
            w = text.words([b.translate(_LOWER) for b in text.encoded(batch.column("text"))], WORD)
            places = [[{"word": a, "label": x} for a, x in sorted(p)] for p in scanner.base(w)]
            spans = [
                [{k: getattr(s, k) for k in ("label", "start", "end", "covered", "share")} for s in all_]
                for all_ in scanner.spans(w)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(np.diff(w.first)), pa.array(places, place), pa.array(spans, span)],
                names=["_row", "n_words", "places", "spans"],
            )

    kind = rows.schema["_row"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"_row {kind}, n_words long, places array<struct<word: long, label: string>>,"
        " spans array<struct<label: string, start: long, end: long, covered: long, share: double>>",
    )


def labelled(scanned: DataFrame) -> DataFrame:
    """The scan as columns: counts, places, labels and a score.

    The score is the largest share of a template that a chain covers; a phrase alone
    gives at least 0.5. Labels are distinct, sorted and joined by commas (empty if none).
    """
    base = F.array_sort(F.array_distinct("places.label"))
    every = F.array_sort(F.array_distinct(F.concat("places.label", "spans.label")))
    phrase = F.when(F.size("places") > 0, F.lit(0.5)).otherwise(F.lit(0.0))
    return scanned.select(
        "_row",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.greatest(phrase, F.coalesce(F.array_max("spans.share"), F.lit(0.0))).alias("score"),
        "spans",
    )
