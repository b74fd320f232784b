"""Toxicity scores: averaged character n-gram embeddings into a linear softmax."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starweave.llm import text

NGRAMS = (3, 4, 5)
BUCKETS = 1 << 18
SIZE = 8
#: Words that are averaged at a time; a text is as toxic as its worst window.
WINDOW = 24
FEWEST = 8
#: Bounds on what the classifier is fitted on: labelled rows by label, and characters in all.
SAMPLE = {1: 2500, 0: 3500}
SAMPLE_CHARS = 1 << 25
#: Weight of the toxic class in the loss.
TOXIC_SHARE = 0.6

_ALNUM = np.array([chr(c).isalnum() for c in range(0x10000)])
_PRIME = np.uint64(text.seeded(1, 31)[0] | np.uint64(1))


@dataclass
class Windows:
    """Distinct words of some texts as n-gram buckets, and the windows made of them."""

    gram: np.ndarray  # buckets of the n-grams of all distinct words
    gram_start: np.ndarray  # first n-gram of each distinct word
    word: np.ndarray  # distinct words of the windows, one window after the other
    start: np.ndarray  # first word of each window
    doc: np.ndarray  # text of each window
    n_docs: int
    key: np.ndarray  # hash of each distinct word

    @property
    def gram_n(self) -> np.ndarray:
        return np.diff(np.append(self.gram_start, len(self.gram)))


def joined(parts: Sequence[Windows]) -> Windows:
    """The windows of several blocks of texts as one, equal words being one."""
    keys = np.concatenate([p.key for p in parts])
    _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    sizes = np.concatenate([p.gram_n for p in parts])
    n = sizes[first]
    start = np.cumsum(n) - n
    # Each word's n-grams come from the first block that has it.
    grams = np.empty(int(n.sum()), np.int32)
    rank = np.full(len(keys), -1, np.int64)
    rank[first] = np.arange(len(first))
    base = 0
    for p in parts:
        here = rank[base : base + len(p.key)]
        new = np.repeat(here >= 0, p.gram_n)
        size = p.gram_n[here >= 0]
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        grams[np.repeat(start[here[here >= 0]], size) + inside] = p.gram[new]
        base += len(p.key)
    words, windows_, docs = [], [], []
    key_base = word_base = doc_base = 0
    for p in parts:
        words.append(inverse[key_base + p.word].astype(np.int32))
        windows_.append(p.start + word_base)
        docs.append(p.doc + doc_base)
        key_base, word_base, doc_base = key_base + len(p.key), word_base + len(p.word), doc_base + p.n_docs
    return Windows(
        grams, start, np.concatenate(words), np.concatenate(windows_), np.concatenate(docs), doc_base, keys[first]
    )


def _grams(codes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of words, each between two edge marks, and the word as a whole."""
    padded = size + 2
    first = np.cumsum(padded) - padded
    which = np.repeat(np.arange(len(size)), padded)
    flat = np.full(int(padded.sum()), 1, np.uint64)
    inside = np.ones(len(flat), bool)
    inside[first] = False
    inside[first + padded - 1] = False
    flat[first + padded - 1] = 2
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    flat[inside] = codes[at + np.repeat(begin, size)].astype(np.uint64) + np.uint64(3)
    found, owner = [], []
    with np.errstate(over="ignore"):
        for n in NGRAMS:
            if len(flat) < n:
                continue
            h = np.zeros(len(flat) - n + 1, np.uint64)
            for j in range(n):
                h = h * _PRIME + flat[j : len(flat) - n + 1 + j]
            ok = which[: len(h)] == which[n - 1 :]
            found.append(text.mix(h[ok] + np.uint64(n)))
            owner.append(which[: len(h)][ok])
        power = np.arange(int(padded.max())).astype(np.uint64)
        whole = np.add.reduceat(text.mix(flat + power[np.arange(len(flat)) - np.repeat(first, padded)] * _PRIME), first)
    found.append(text.mix(whole))
    owner.append(np.arange(len(size)))
    owner, found = np.concatenate(owner), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    start = np.searchsorted(owner[order], np.arange(len(size)))
    return (found[order] % np.uint64(BUCKETS)).astype(np.int32), start


def windows(texts: Sequence[str], window: int = WINDOW) -> Windows:
    """Words (runs of letters and digits, in lower case) of texts, cut into windows.

    A text of n words has ceil(n / window) windows of nearly equal length, one
    without words has none.
    """
    lower = [t.lower() for t in texts]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in lower]))).astype(np.int64)
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _ALNUM[np.minimum(codes, 0xFFFF)] | (codes > 0xFFFF)
    edge = np.zeros(len(codes) + 1, bool)
    edge[bounds] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
    after = np.concatenate((inside[1:], [False])) & ~edge[1:]
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    size = end - start
    counts = np.diff(np.searchsorted(start, bounds))
    if not len(start):
        none = np.empty(0, np.int64)
        return Windows(none, none, none, none, none, len(texts), none.astype(np.uint64))
    total = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(total[-1]) - np.repeat(total[:-1], size)
    with np.errstate(over="ignore"):
        spread = text.mix(codes[at + np.repeat(start, size)].astype(np.uint64) + at.astype(np.uint64) * _PRIME)
        key = np.add.reduceat(spread, total[:-1])
    key, sample, word = np.unique(key, return_index=True, return_inverse=True)
    gram, gram_start = _grams(codes, start[sample], size[sample])
    pieces = -(-counts // window)
    doc = np.repeat(np.arange(len(texts)), pieces)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = (np.cumsum(counts) - counts)[doc] + nth * counts[doc] // np.maximum(pieces[doc], 1)
    # A word counts once in a window, so that a row of equal words weighs as one of them.
    inside = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(word))))
    inside, word = np.divmod(np.unique(inside * len(key) + word), len(key))
    first = np.searchsorted(inside, np.arange(len(first)))
    return Windows(gram, gram_start, word, first, doc, len(texts), key)


def _mean(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, start) / np.diff(np.append(start, len(values)))


def _window_mean(of_word: np.ndarray, w: Windows) -> np.ndarray:
    """Means over windows; what a window lacks of ``WINDOW`` different words is zero."""
    return np.add.reduceat(of_word[w.word], w.start) / WINDOW


@dataclass
class Model:
    """Score of a bucket (its embedding times the difference of the two classes' softmax
    weights) and the difference of their biases."""

    bucket: np.ndarray
    bias: float

    def margins(self, w: Windows) -> np.ndarray:
        """Log odds of the toxic class, of each text: those of its worst window."""
        out = np.full(w.n_docs, -np.inf)
        if len(w.start):
            of_word = _mean(self.bucket[w.gram], w.gram_start)
            np.maximum.at(out, w.doc, _window_mean(of_word, w) + self.bias)
        return np.where(np.isinf(out), self.bias, out)

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(windows(texts)), -60, 60)))


def _parts(n: int, size: int = 1 << 22) -> list[slice]:
    """Slices of a long array, so that what is made of each stays small."""
    return [slice(a, min(n, a + size)) for a in range(0, n, size)]


def _untrained() -> Model:
    return Model(np.zeros(BUCKETS, np.float32), 0.0)


def train(texts: Sequence[str], labels: Sequence[int], **how) -> Model:
    """The model of some texts, see ``train_windows``."""
    if not len(texts):
        return _untrained()
    return train_windows(joined([windows(texts[i : i + 200]) for i in range(0, len(texts), 200)]), labels, **how)


def train_windows(
    w: Windows,
    labels: Sequence[int],
    steps: int = 70,
    rate: float = 0.1,
    decay: float = 3e-5,
    seed: int = 0,
) -> Model:
    """Embeddings and softmax weights, fitted together by Adam on all rows at once.

    A window's logits are W times the mean over its words of the mean of their
    n-gram vectors, plus b. A toxic text learns through its worst window, a clean one
    through all of them, weighted by how toxic each looks. As all of it is linear up to
    the softmax, W is applied to the n-gram vectors first and the means are taken of the
    products; the gradients go back the same way.
    """
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.float64)
    if not len(w.start):
        return _untrained()
    # Buckets met less often than FEWEST times keep the zero vector.
    gram_n = np.maximum(w.gram_n, 1)
    gram_word = np.repeat(np.arange(len(gram_n), dtype=np.int32), w.gram_n)
    often = np.bincount(w.word, minlength=len(gram_n))
    met = np.zeros(BUCKETS)
    for part in _parts(len(gram_word)):
        met += np.bincount(w.gram[part], often[gram_word[part]], BUCKETS)
    used = np.flatnonzero(met >= FEWEST)
    if not len(used):
        return _untrained()
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    known = place[w.gram] >= 0
    gram, gram_word = place[w.gram[known]], gram_word[known]
    vectors = rng.normal(0, 0.3, (len(used), SIZE))
    weight = rng.normal(0, 0.3, (SIZE, 2))
    bias = np.zeros(2)
    word_n = np.diff(np.append(w.start, len(w.word)))
    word_window = np.repeat(np.arange(len(word_n), dtype=np.int32), word_n)
    # The toxic class weighs more in the loss than the clean one.
    share = np.where(y == 1, TOXIC_SHARE / max(1, (y == 1).sum()), (1 - TOXIC_SHARE) / max(1, (y == 0).sum()))
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (vectors, weight, bias)]
    for step in range(1, steps + 1):
        apart = weight[:, 1] - weight[:, 0]
        of_bucket = vectors @ apart
        of_word = np.zeros(len(gram_n))
        for part in _parts(len(gram)):
            a = gram_word[part][0]
            sums = np.bincount(gram_word[part] - a, of_bucket[gram[part]])
            of_word[a : a + len(sums)] += sums
        of_word /= gram_n
        margin = _window_mean(of_word, w) + bias[1] - bias[0]
        top = np.full(w.n_docs, -np.inf)
        np.maximum.at(top, w.doc, margin)
        # Weight of a window within its text: the worst ones count.
        soft = np.exp(4 * (margin - top[w.doc]))
        soft /= np.bincount(w.doc, soft, w.n_docs)[w.doc]
        wrong = 1 / (1 + np.exp(-np.clip(margin, -60, 60))) - y[w.doc]
        d_margin = wrong * soft * share[w.doc]
        d_word = np.bincount(w.word, (d_margin / WINDOW)[word_window], len(gram_n))
        d_word /= gram_n
        d_bucket = np.zeros(len(used))
        for part in _parts(len(gram)):
            d_bucket += np.bincount(gram[part], d_word[gram_word[part]], len(used))
        d_apart = vectors.T @ d_bucket
        slopes = (
            d_bucket[:, None] * apart + decay * vectors,
            np.stack([-d_apart, d_apart], axis=1) + decay * weight,
            np.array([-1.0, 1.0]) * d_margin.sum(),
        )
        for p, slope, (m, v) in zip((vectors, weight, bias), slopes, state):
            m += 0.1 * (slope - m)
            v += 0.001 * (slope * slope - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    out = np.zeros(BUCKETS, np.float32)
    out[used] = vectors @ (weight[:, 1] - weight[:, 0])
    return Model(out, float(bias[1] - bias[0]))


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is kept from training: crc32 of its id as text, mod ``folds``, is 0.

    False for a null id, which no label can name either.
    """
    checksum = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    return F.coalesce(checksum % folds == 0, F.lit(False))


def _fitted(most_chars: int):
    """A function that trains on the rows of its partition and returns the model as one row.
    Only the windows of a text are kept, as numbers."""

    def run(batches):
        parts, labels, left = [], [], most_chars
        for batch in text.blocks(batches, "text"):
            some = []
            for body, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                if len(body) <= left:
                    left -= len(body)
                    some.append(body)
                    labels.append(label)
            if some:
                parts.append(windows(some))
        model = train_windows(joined(parts), labels) if len(set(labels)) > 1 else _untrained()
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.bucket.tobytes()], pa.binary()), pa.array([model.bias], pa.float64())],
            names=["bucket", "bias"],
        )

    return run


def fit(
    docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None, most_chars: int = SAMPLE_CHARS
) -> Model:
    """Train on labelled rows that are not held out.

    At most ``sample[label]`` ids of each label are learnt from, those whose hash is
    lowest, and of these only as many as have ``most_chars`` characters in all (a text that
    would exceed that is passed over); the bounds do not grow with the input. One task
    learns from them, only the model comes to the driver. Of several labels of an id the
    toxic one counts, of several texts the last in order. Rows without label or text are
    left out. Without any row of both labels every score is 0.5.
    """
    sample = sample or SAMPLE
    marked = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("_order", F.xxhash64("doc_id"))
    )
    # Labels for which no document is left must not use up the bound.
    there = marked.join(docs.select("doc_id").filter("doc_id IS NOT NULL").distinct(), "doc_id")
    chosen = [
        there.filter(F.col("toxic") == label).orderBy("_order", "doc_id").limit(n)
        for label, n in sample.items()
    ]
    some = chosen[0]
    for more in chosen[1:]:
        some = some.unionAll(more)
    rows = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(some), "doc_id")  # the sample: its size is bounded
        .groupBy("doc_id", "toxic")
        .agg(F.max("text").alias("text"))
        .coalesce(1)  # bounded, as above
        .sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    )
    found = rows.select("toxic", "text").mapInArrow(_fitted(most_chars), "bucket binary, bias double").first()
    return Model(np.frombuffer(found["bucket"], np.float32), found["bias"]) if found else _untrained()


def score(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """All rows as ``_row`` (a struct of their columns) with their ``score`` from 0 to 1.

    Whole texts are scored, in every task with the same small model. A null text counts
    as empty; a text without words gets the score of the bias alone. Equal texts have
    equal scores.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )

    def run(batches):
        for batch in text.blocks(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(model.scores(texts), pa.float64())], names=["_row", "score"]
            )

    return rows.mapInArrow(run, f"_row {rows.schema['_row'].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows whose score is below the threshold, with the columns they had."""
    scored = score(docs, fit(docs, labels)).filter(F.col("score") < threshold)
    return scored.select(*(F.col(f"_row.`{c}`") for c in docs.columns))
