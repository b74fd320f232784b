"""Quality rules on words and on how well a public vocabulary fits a text."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from starweave.llm import text
from starweave.llm.scratch import Scratch

FEWEST_WORDS = 10
#: Percent of the words that may lie in repeated five-word windows.
MOST_REPEATED = 20
SYMBOLS = text.byte_class(lambda b: chr(b) in "#*$%&|<>")
SPACE = " \t\n\x0b\x0c\r"

#: Measures of fertility, each with the side on which it is judged.
MEASURES = {"chars_per_token": "both", "byte_share": "high", "token_entropy": "low"}
#: A band reaches so many times the distance of the quartiles from the median, at least
#: by the share ``LEAST`` of the median (of 1, for the share of byte tokens). It is made
#: for texts of one group and about one length, as short texts scatter more. The quartiles of n
#: different texts weigh n / (n + ``PRIOR_ROWS``) against those of the next wider set: the
#: neighbouring lengths too, the whole group, all rows.
REACH = 5.0
LEAST = 0.05
PRIOR_ROWS = 25
#: Digits of the measures' values that the quartiles are made of: an exact count of each, so
#: the order in which tasks meet does not matter, and the counts of a set stay few.
DIGITS = 3


class WordVocabulary:
    """Pieces of single words in a sentencepiece vocabulary, with a cache by word hash.

    The cache is emptied when full, which changes the speed only.
    """

    def __init__(self, path: str, limit: int = 300_000):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.byte = np.array([self.model.is_byte(i) for i in range(size)])
        self.limit = limit
        self.cache: dict[int, bytes] = {}

    def __call__(self, w: text.Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of a block one after the other, and the number of each word's."""
        key, sample, which = np.unique(w.hash, return_index=True, return_inverse=True)
        keys = key.tolist()
        new = [i for i, k in enumerate(keys) if k not in self.cache]
        if len(self.cache) + len(new) > self.limit:
            self.cache.clear()
            new = list(range(len(keys)))
        if new:
            data = w.data.tobytes()
            start, end = w.start[sample].tolist(), w.end[sample].tolist()
            bodies = [data[start[i] : end[i]].decode("utf-8", "replace") for i in new]
            for i, ids in zip(new, self.model.encode(bodies, num_threads=1)):
                self.cache[keys[i]] = np.array(ids, "<u2" if len(self.byte) < 1 << 16 else "<u4").tobytes()
        kind = "<u2" if len(self.byte) < 1 << 16 else "<u4"
        parts = [self.cache[k] for k in keys]
        pool = np.frombuffer(b"".join(parts), kind)
        n = np.array([len(p) // pool.itemsize for p in parts], np.int64)
        first = np.cumsum(n) - n
        count = n[which]
        done = np.cumsum(count) - count
        at = np.arange(int(count.sum())) + np.repeat(first[which] - done, count)
        return pool[at], count


_VOCABULARIES: dict[str, WordVocabulary] = {}


def vocabulary(path: str) -> WordVocabulary:
    """One vocabulary per Python worker."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = WordVocabulary(path)
    return _VOCABULARIES[path]


def duplicate_lines(body: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = body.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    seen, found = set(), 0
    for line in lines:
        if line in seen:
            found += bool(line.strip(SPACE))
        else:
            seen.add(line)
    return found


def repeated_words(w: text.Words, k: int = 5) -> np.ndarray:
    """Of each text, the words that lie in a window of ``k`` words found twice or more."""
    full = np.diff(w.first) >= k
    shingle, doc, at = text.shingles(w, k)
    long_ = full[doc]
    shingle, doc, at = shingle[long_], doc[long_], at[long_]
    if not len(shingle):
        return np.zeros(w.n_docs, np.int64)
    order = np.lexsort((shingle, doc))
    s, d = shingle[order], doc[order]
    same = (s[1:] == s[:-1]) & (d[1:] == d[:-1])
    again = np.zeros(len(s), bool)
    again[1:] |= same
    again[:-1] |= same
    edge = np.zeros(len(w.start) + 1, np.int64)
    np.add.at(edge, at[order][again], 1)
    np.add.at(edge, at[order][again] + k, -1)
    return w.per_doc(np.cumsum(edge[:-1]) > 0)


def fertility(w: text.Words, chars: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: tokens, characters per token, share of byte tokens, token entropy.

    The entropy is that of the text's tokens in bits over its highest value, log2 of their
    number. A text without tokens gets zeros.
    """
    model = vocabulary(path)
    ids, count = model(w)
    tokens = w.per_doc(count)
    ends = np.concatenate(([0], np.cumsum(count)))
    bounds = ends[w.first]
    byte = np.concatenate(([0], np.cumsum(model.byte[ids])))
    some = np.maximum(tokens, 1)
    key = np.repeat(np.arange(w.n_docs), tokens) * len(model.byte) + ids
    key, n = np.unique(key, return_counts=True)
    doc = key // len(model.byte)
    part = n / some[doc]
    entropy = np.bincount(doc, -part * np.log2(part), w.n_docs)
    top = np.log2(np.maximum(tokens, 2))
    return tokens, chars / some, (byte[bounds[1:]] - byte[bounds[:-1]]) / some, entropy / top


def script(body: str) -> str:
    """Script of most letters among the first words of Unicode's letter names."""
    found: dict[str, int] = {}
    for c in set(body):
        if c.isalpha():
            name = "LATIN" if c < "ɐ" else unicodedata.name(c, "OTHER").split(" ")[0].split("-")[0]
            found[name] = found.get(name, 0) + body.count(c)
    return max(sorted(found), key=found.get) if found else "NONE"


def _measure(path: str, group: str):
    def run(batches):
        for batch in text.blocks(batches, "text"):
            bodies = text.encoded(batch.column("text"))
            w = text.words(bodies)
            lead = (w.data & 0xC0) != 0x80
            codes = np.concatenate(([0], np.cumsum(lead)))
            chars = w.per_doc(codes[w.end] - codes[w.start])
            texts = [b.decode("utf-8") for b in bodies]
            measured = fertility(w, chars, path)
            found = {
                "n_words": np.diff(w.first),
                "word_chars": chars,
                "n_symbols": w.per_doc_bytes(SYMBOLS[w.data]),
                "n_dup_lines": np.array([duplicate_lines(t) for t in texts], np.int64),
                "n_repeat_words": repeated_words(w),
                "n_tokens": measured[0],
                "chars_per_token": measured[1],
                "byte_share": measured[2],
                "token_entropy": measured[3],
            }
            names = batch.column("group").to_pylist()
            if group == "script":
                names = [script(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"), pa.array(names, pa.string()), batch.column("same"),
                    *(pa.array(v) for v in found.values()),
                ],
                names=["_row", "group", "same", *found],
            )

    return run


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")


def measures(docs: DataFrame, path: str, group: str = "script") -> DataFrame:
    """All rows as ``_row`` with the counts and measures of their whole texts.

    ``group`` is a column that names the language, or ``script``: then the script is
    found from the letters; ``same`` is a hash of the text. A null text counts as empty.
    """
    named = F.lit(None).cast("string") if group == "script" else F.col(f"`{group}`").cast("string")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("_row"),
        named.alias("group"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("same"),
    )
    kind = rows.schema["_row"].dataType.simpleString()
    numbers = [f"{c} long" for c in COUNTS] + [f"{c} double" for c in MEASURES]
    return rows.mapInArrow(_measure(path, group), f"_row {kind}, group string, same long, {', '.join(numbers)}")


def base_failed() -> Column:
    """Too few words, or too many in repeated windows."""
    return (F.col("n_words") < FEWEST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


def length_class() -> Column:
    """Whole part of log2 of the number of tokens."""
    return F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).cast("int")


def bands(measured: DataFrame) -> DataFrame:
    """The band of every measure for each group and length class, from texts that pass the
    base rules: the class's own quartiles, blended with those of wider sets by the number of
    texts in each. Equal texts count once, so that copies do not make the band."""
    alike = [F.max(c).alias(c) for c in ("n_tokens", *MEASURES)]
    rows = measured.filter(~base_failed()).groupBy("group", "same").agg(*alike)
    group, of = F.col("group"), length_class()
    none = F.lit(None)
    near = F.transform(F.array(of - 1, of, of + 1), lambda c: _level(1, group, c))
    sets = F.concat(F.array(_level(0, group, of)), near, F.array(_level(2, group, none), _level(3, none, none)))
    quartiles = [F.percentile(F.round(m, DIGITS), F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias(m) for m in MEASURES]
    found = (
        rows.select(F.explode(sets).alias("_set"), *MEASURES)
        .groupBy("_set.level", "_set.group", "_set.class")
        .agg(*quartiles, F.count("*").alias("rows"))
    )
    found = found.select("level", "group", "class", F.struct("rows", *MEASURES).alias("_found"))
    wanted = measured.select(group.alias("_group"), of.alias("_class")).distinct()
    own, length = F.col("_group"), F.col("_class")
    sets = F.array(_level(0, own, length), _level(1, own, length), _level(2, own, none), _level(3, none, none))
    wanted = wanted.select("_group", "_class", F.explode(sets).alias("_set"))
    met = (
        (F.col("_set.level") == F.col("level"))
        & F.col("_set.group").eqNullSafe(F.col("group"))
        & F.col("_set.class").eqNullSafe(F.col("class"))
    )
    levels = [F.max(F.when(F.col("level") == k, F.col("_found"))).alias(f"_level{k}") for k in range(4)]
    chosen = wanted.join(found, met).groupBy("_group", "_class").agg(*levels)
    columns = []
    for m in MEASURES:
        low, mid, high = (_blended(m, i) for i in range(3))
        least = F.lit(LEAST) if m == "byte_share" else LEAST * mid
        reach = F.greatest(REACH * (high - low), least)
        columns += [(mid - reach).alias(f"{m}_low"), (mid + reach).alias(f"{m}_high")]
    return chosen.select("_group", "_class", *columns)


def _blended(measure: str, quartile: int) -> Column:
    """A quartile of the widest set, moved towards each narrower one by its number of texts."""
    value = F.col(f"_level3.{measure}")[quartile]
    for k in (2, 1, 0):
        n = F.col(f"_level{k}.rows")
        nearer = (n * F.col(f"_level{k}.{measure}")[quartile] + PRIOR_ROWS * value) / (n + PRIOR_ROWS)
        value = F.coalesce(nearer, value)
    return value


def _level(level: int, group: Column, length: Column) -> Column:
    """A set of rows: 0 for a length class of a group, 1 with its neighbours, 2 for the
    group, 3 for all rows."""
    return F.struct(
        F.lit(level).alias("level"), group.cast("string").alias("group"), length.cast("int").alias("class")
    )


def quality(
    docs: DataFrame, path: str, group: str = "lang", scratch: Scratch | None = None
) -> DataFrame:
    """Counts, fertility measures and verdict of every row.

    A text is rejected if it fails the base rules, or if a measure leaves the band of
    its group (language or script; null is a group of its own) and length: characters per token on
    either side, the share of byte-fallback tokens above, the token entropy below. The
    bands are made from all rows; the fewer different texts a group and length has, the more
    its band is that of wider sets. Repeated rows are judged alike. Adds ``base_failed``,
    ``out_of_band`` and ``kept``.
    """
    scratch = scratch or Scratch(docs.sparkSession, "quality")
    measured = scratch.keep(measures(docs, path, group), "measures")
    limits = scratch.keep(bands(measured), "bands")
    same = F.col("group").eqNullSafe(F.col("_group")) & (length_class() == F.col("_class"))
    joined = measured.join(limits, same, "left")
    outside = F.lit(False)
    for m, side in MEASURES.items():
        if side != "high":
            outside = outside | (F.col(m) < F.col(f"{m}_low"))
        if side != "low":
            outside = outside | (F.col(m) > F.col(f"{m}_high"))
    outside = F.coalesce(outside, F.lit(False))
    return joined.select(
        *(c for c in measured.columns if c != "same"),
        base_failed().alias("base_failed"),
        outside.alias("out_of_band"),
        (~base_failed() & ~outside).alias("kept"),
    )
