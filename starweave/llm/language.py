"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starweave.llm import text

#: n-grams have 1 to LONGEST characters: so many code points fit one 64-bit key exactly.
LONGEST = 3
_CODE_BITS = np.uint64(21)
#: Ranks of a profile, of a language and of a document.
PROFILE = 400
#: Characters that are turned into n-grams at a time.
SLICE = 1 << 18
#: Different n-grams that a task gathers for a language before it passes their counts on.
GATHERED = 1 << 20
#: Languages that a model may have: it goes to every task, so its size must have a bound.
MOST_LANGUAGES = 10_000
UNKNOWN = "und"

#: Stands for all that is not part of a word. No letter has this code.
_EDGE = 1


@cache
def _word_characters() -> np.ndarray:
    """Of each code point, whether it is part of words: letters and the marks on them."""
    return np.array([chr(c).isalpha() or unicodedata.category(chr(c))[0] == "M" for c in range(0x110000)])


def has_letter(body: str) -> bool:
    return any(c.isalpha() for c in body)


def _keys(codes: np.ndarray, known: int) -> np.ndarray:
    """Keys of the n-grams that end behind the first ``known`` codes of a word stream.

    A word may be joined by its edges, but no n-gram reaches over one, nor is an edge one.
    """
    c = codes.astype(np.uint64)
    edge = codes == _EDGE
    out = [c[known:][~edge[known:]]]
    for n in range(2, LONGEST + 1):
        if len(c) < n:
            break
        start = max(0, known - n + 1)
        at = np.arange(start, len(c) - n + 1)
        good = np.ones(len(at), bool)
        for j in range(1, n - 1):
            good &= ~edge[at + j]
        if n == 2:
            good &= ~(edge[at] & edge[at + 1])
        at = at[good]
        key = c[at]
        for j in range(1, n):
            key = key | c[at + j] << (_CODE_BITS * np.uint64(j))
        out.append(key)
    return np.concatenate(out)


def _slices(body: str) -> Iterator[np.ndarray]:
    """Keys of all n-grams of a text, a slice of it at a time."""
    inside = _word_characters()
    carry = np.array([_EDGE], np.uint32)
    for a in range(0, max(len(body), 1), SLICE):
        part = body[a : a + SLICE].casefold().encode("utf-32-le", "replace")
        codes = np.frombuffer(part, np.uint32)
        codes = np.where(inside[codes], codes, _EDGE)
        if a + SLICE >= len(body):
            codes = np.append(codes, np.uint32(_EDGE))
        stream = np.concatenate((carry, codes.astype(np.uint32)))
        # Neighbouring edges are one.
        fresh = np.ones(len(stream), bool)
        fresh[1:] = (stream[1:] != _EDGE) | (stream[:-1] != _EDGE)
        fresh[: len(carry)] = True
        stream = stream[fresh]
        yield _keys(stream, len(carry))
        carry = stream[-(LONGEST - 1) :]


def _merged(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys, each once and rising, with the sums of their counts."""
    if len(parts) == 1:
        return parts[0]
    key, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return key, np.bincount(place, np.concatenate([n for _, n in parts]), len(key)).astype(np.int64)


def grams(body: str) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of a whole text with their counts."""
    return _merged([np.unique(k, return_counts=True) for k in _slices(body)])


def gram_text(key: int) -> str:
    """The characters of a key, edges as ``_``."""
    out = ""
    while key:
        code = key & ((1 << int(_CODE_BITS)) - 1)
        out, key = out + ("_" if code == _EDGE else chr(code)), key >> int(_CODE_BITS)
    return out


def top(key: np.ndarray, count: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent keys, in order; of equally frequent ones the lower key is first."""
    if len(key) > 4 * size:
        # Only counts that can be among the first are sorted.
        least = np.partition(count, len(count) - size)[len(count) - size]
        key, count = key[count >= least], count[count >= least]
    return key[np.lexsort((key, -count))[:size]]


class Profiles:
    """Profiles of all languages: of each n-gram, the languages that rank it, and how."""

    def __init__(self, languages: Sequence[str], lang: np.ndarray, rank: np.ndarray, key: np.ndarray):
        """``lang``, ``rank`` and ``key`` have an entry for each rank of each language."""
        self.languages = list(languages)
        order = np.lexsort((lang, key))
        self.lang, self.rank = lang[order], rank[order]
        self.key, self.first = np.unique(key[order], return_index=True)
        self.first = np.append(self.first, len(order))

    def predict(self, body: str) -> tuple[str, float]:
        """The nearest language and how near it is.

        The distance is the sum, over the document's ranks, of how far the n-gram is out of its
        place in the language's profile, or ``PROFILE`` where it is not in it. The score is 1 less
        the share of the largest distance that there could be. Of equally near
        languages the first by code point is taken.
        """
        if not self.languages or not has_letter(body):
            return UNKNOWN, 0.0
        mine = top(*grams(body))
        at = np.minimum(np.searchsorted(self.key, mine), len(self.key) - 1)
        here = np.flatnonzero(self.key[at] == mine)
        size = self.first[at[here] + 1] - self.first[at[here]]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        entry = inside + np.repeat(self.first[at[here]], size)
        saved = PROFILE - np.abs(self.rank[entry] - np.repeat(here, size))
        total = np.bincount(self.lang[entry], saved, len(self.languages))
        best = int(np.argmax(total))
        return self.languages[best], float(total[best] / (PROFILE * len(mine)))


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text, mod ``folds``, is
    ``fold``. False for a null id."""
    checksum = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    return F.coalesce(checksum % folds == fold, F.lit(False))


def gram_counts(docs: DataFrame) -> DataFrame:
    """(``lang``, ``gram``, ``n``) of all rows with a language, summed within tasks first, so
    that a language that a third of the rows have is a row for each task and n-gram."""

    def count(batches):
        found: dict[str, list] = {}

        def rows(lang):
            key, n = _merged(found.pop(lang))
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(key), pa.string()), pa.array(key.view(np.int64)), pa.array(n)],
                names=["lang", "gram", "n"],
            )

        for batch in batches:
            for piece in text.blocks([batch], "text"):
                by_lang: dict[str, list[str]] = {}
                for lang, body in zip(piece.column("lang").to_pylist(), piece.column("text").to_pylist()):
                    by_lang.setdefault(lang, []).append(body)
                for lang, bodies in by_lang.items():
                    # A line end is an edge: texts do not share n-grams.
                    found[lang] = [_merged([*found.get(lang, []), grams("\n".join(bodies))])]
            if sum(len(parts[0][0]) for parts in found.values()) > GATHERED:
                yield from [rows(lang) for lang in list(found)]
        yield from [rows(lang) for lang in list(found)]

    learned = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = learned.select(F.col("lang").cast("string"), F.col("text").cast("string")).mapInArrow(
        count, "lang string, gram long, n long"
    )
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame) -> Profiles:
    """Profiles of all languages in ``lang``, from every row with a language and a text.

    Of equally frequent n-grams the lower key ranks first. A language whose texts have no
    letter has no profile. A profile is ``PROFILE`` rows, whatever the input's size; more than
    ``MOST_LANGUAGES`` languages are an error, as the column does not name languages then.
    """
    place = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    ranked = gram_counts(docs).withColumn("rank", F.row_number().over(place) - 1).filter(F.col("rank") < PROFILE)
    found = ranked.select("lang", "gram", "rank").limit(MOST_LANGUAGES * PROFILE + 1).toPandas()
    languages = sorted(found["lang"].unique())
    if len(languages) > MOST_LANGUAGES or len(found) > MOST_LANGUAGES * PROFILE:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    lang = np.searchsorted(np.array(languages, object), found["lang"].to_numpy(object))
    return Profiles(
        languages,
        lang.astype(np.int32),
        found["rank"].to_numpy(np.int32),
        found["gram"].to_numpy(np.int64).view(np.uint64),
    )


def identify(docs: DataFrame, profiles: Profiles, text_column: str = "text") -> DataFrame:
    """All rows as ``_row`` (a struct of their columns) with ``lang_pred`` and ``score``.

    Whole texts are read. A null text, one without a letter, and any text when no
    language was learned are ``und`` with score 0. Equal texts have equal results; repeated rows
    are rows of their own.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )

    def run(batches):
        for batch in text.blocks(batches, "text"):
            found = [profiles.predict(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["_row", "lang_pred", "score"],
            )

    kind = rows.schema["_row"].dataType.simpleString()
    return rows.mapInArrow(run, f"_row {kind}, lang_pred string, score double")
