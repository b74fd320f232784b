"""Whitening of embeddings by components of the exact integer scatter matrix."""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction
from itertools import islice
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from starweave.llm import charpoly
from starweave.llm.scratch import Scratch

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Entries that a long cannot hold after scaling make a vector as unusable as infinite ones.
LARGEST = float(1 << 52)
#: Sums travel as digits to this base, so that they are exact whatever their size.
DIGIT_BITS = 56
#: Bits of a number whose products float64 sums exactly, with the sum's share.
LIMB_BITS, SUM_BITS = 20, 13
#: Vectors that a task holds as arrays at a time.
BLOCK_ROWS = 1 << SUM_BITS
#: Primes that one task takes at a time.
TASK_PRIMES = 16


@dataclass(frozen=True)
class Whitening:
    """Components of the fitted vectors.

    ``total`` holds the sum of each dimension's integers, ``weights`` a column for each
    component: its direction over the square root of its eigenvalue.
    """

    n: int
    total: tuple[int, ...]
    explained: tuple[float, ...]
    weights: np.ndarray

    @property
    def size(self) -> int:
        return len(self.total)


def usable(column: pa.Array, size: int | None = None) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Vectors without null or non-finite entries, as integers.

    Which rows are usable (of length ``size`` if given), and for each length the places of its rows
    and their matrix.
    """
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    entries = column.flatten()  # null lists have none
    first = np.concatenate(([0], np.cumsum(lengths)))
    value = np.asarray(entries.fill_null(np.nan), np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        value = np.floor(value * SCALE)
        bad = ~(np.abs(value) < LARGEST)
    wrong = np.concatenate(([0], np.cumsum(bad)))
    good = (lengths > 0) & (wrong[first[1:]] == wrong[first[:-1]])
    if size is not None:
        good &= lengths == size
    groups = []
    for length in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == length))
        at = first[rows][:, None] + np.arange(length)
        groups.append((rows, value[at].astype(np.int64) + OFFSET))
    return good, groups


def gram(y: np.ndarray) -> np.ndarray:
    """y' y as exact integers: products of limbs, which float64 sums without rounding."""
    limbs, rest = [], y
    while True:
        last = bool((np.abs(rest) < 1 << LIMB_BITS).all())
        low = rest if last else rest & ((1 << LIMB_BITS) - 1)
        limbs.append(low.astype(np.float64))
        if last:
            break
        rest = rest >> LIMB_BITS
    out = np.zeros((y.shape[1], y.shape[1]), object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            out += (a.T @ b).astype(np.int64).astype(object) << (LIMB_BITS * (i + j))
    return out


def _digits(values: dict[tuple[int, int, int], int]) -> pa.RecordBatch:
    """Rows (length, i, j, digit, value) of large integers; the last digit has the sign."""
    rows = []
    for (length, i, j), value in values.items():
        digit = 0
        while abs(value) >> DIGIT_BITS:
            rows.append((length, i, j, digit, value & ((1 << DIGIT_BITS) - 1)))
            value, digit = value >> DIGIT_BITS, digit + 1
        rows.append((length, i, j, digit, value))
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["length", "i", "j", "digit", "value"])


_DIGITS = "length long, i long, j long, digit long, value long"


def _summed(parts: DataFrame) -> dict[tuple[int, int, int], int]:
    """Sums by (length, i, j): as many as a matrix of one dimension has entries."""
    total = F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    out: dict[tuple[int, int, int], int] = {}
    for r in parts.groupBy("length", "i", "j", "digit").agg(total).collect():
        key = r["length"], r["i"], r["j"]
        out[key] = out.get(key, 0) + (int(r["value"]) << (DIGIT_BITS * r["digit"]))
    return out


def _rows(batch: pa.RecordBatch):
    """Pieces of a batch that are small enough to be held as arrays."""
    for a in range(0, batch.num_rows, BLOCK_ROWS):
        yield batch.slice(a, BLOCK_ROWS)


def _vectors(df: DataFrame, vector: str) -> DataFrame:
    return df.select(F.col(f"`{vector}`").cast("array<double>").alias("vector"))


def sums(df: DataFrame, vector: str) -> tuple[int, tuple[int, ...]]:
    """Number of usable vectors and the sums of their dimensions."""

    def add(batches):
        found: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for piece in _rows(batch):
                for rows, x in usable(piece.column("vector"))[1]:
                    length = x.shape[1]
                    # Halves, so that no sum leaves 64 bits.
                    high, low = (x >> 24).sum(axis=0).tolist(), (x & 0xFFFFFF).sum(axis=0).tolist()
                    found[length, -1, -1] = found.get((length, -1, -1), 0) + len(rows)
                    for i, (h, w) in enumerate(zip(high, low)):
                        found[length, i, -1] = found.get((length, i, -1), 0) + (h << 24) + w
        yield _digits(found)

    found = _summed(_vectors(df, vector).mapInArrow(add, _DIGITS))
    counts = {length: n for (length, i, _), n in found.items() if i < 0}
    if not counts:
        return 0, ()
    size = max(counts, key=lambda length: (counts[length], length))
    return counts[size], tuple(found[size, i, -1] for i in range(size))


def scatter(df: DataFrame, vector: str, n: int, total: tuple[int, ...]) -> list[list[int]]:
    """n^2 times the covariance, exactly.

    Every entry is centred by the whole part of its dimension's mean before it is
    multiplied; what that leaves of the mean is taken off the sums of products.
    """
    size = len(total)
    middle = np.array([t // n for t in total], np.int64)

    def add(batches):
        whole = np.zeros((size, size), object)
        for batch in batches:
            for piece in _rows(batch):
                for _, x in usable(piece.column("vector"), size)[1]:
                    whole += gram(x - middle)
        yield _digits({(size, i, j): int(whole[i, j]) for i in range(size) for j in range(i, size) if whole[i, j]})

    found = _summed(_vectors(df, vector).mapInArrow(add, _DIGITS))
    rest = [t - n * int(m) for t, m in zip(total, middle)]
    return [
        [n * found.get((size, min(i, j), max(i, j)), 0) - rest[i] * rest[j] for j in range(size)]
        for i in range(size)
    ]


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of the characteristic polynomial, from the constant up.

    Tasks work modulo some primes each. What comes to the driver is bounded by the size
    of the matrix and the digits of its entries, not by rows.
    """
    moduli = list(islice(charpoly.primes(), charpoly.coefficient_bits(matrix) // 30 + 1))
    parts = [moduli[i : i + TASK_PRIMES] for i in range(0, len(moduli), TASK_PRIMES)]

    def work(batches):
        for batch in batches:
            for at in batch.column("id").to_pylist():
                found = charpoly.polynomials(matrix, parts[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts[at], pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))],
                    names=["prime", "residues"],
                )

    rows = spark.range(0, len(parts), 1, len(parts)).mapInArrow(work, "prime long, residues array<long>").collect()
    return charpoly.combine([r["residues"] for r in rows], [r["prime"] for r in rows])


def fit(df: DataFrame, vector: str = "embedding", count: int = COMPONENTS) -> Whitening:
    """The components of all usable vectors, by falling eigenvalue, ``count`` at most.

    Null vectors, and those with null or non-finite entries or entries of 2^42 and more,
    are left out. So are empty ones, and where lengths differ, all but those of the most
    frequent length (the larger of two). A component without variance is none: vectors that
    are all equal have no component, and without vectors ``n`` is 0. Equal eigenvalues get orthogonal
    directions of their common space.

    The scatter matrix is summed in exact integers, its characteristic polynomial found by
    Hessenberg reduction modulo primes and the Chinese remainder theorem, the real roots
    isolated and refined to far more than double precision, and each direction found by
    inverse iteration in fixed-point numbers.
    """
    n, total = sums(df, vector)
    if not n:
        return Whitening(0, (), (), np.zeros((0, 0)))
    matrix = scatter(df, vector, n, total)
    roots = charpoly.Roots(characteristic(df.sparkSession, matrix))
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    explained: list[float] = []
    weights: list[list[float]] = []
    for a, s, many in roots.largest(count):
        for v in charpoly.null_vectors(matrix, a, s, many)[: count - len(weights)]:
            explained.append(float(Fraction(a, trace << s)))
            # The root is n^2 times the eigenvalue: direction * n / sqrt(root).
            deviation = isqrt((a << 256) >> s) if s < 256 else isqrt(a >> (s - 256))
            weights.append([float(Fraction(x * n << 128, deviation << charpoly.FIXED_BITS)) for x in v])
    return Whitening(n, total, tuple(explained), np.array(weights).reshape(-1, len(total)).T)


def _whitened(w: Whitening):
    """Whitened rows of a matrix of integers: centred, then projected."""
    middle = np.array([t // w.n for t in w.total], np.int64)
    rest = np.array([float(Fraction(t, w.n) - t // w.n) for t in w.total])
    return lambda x: ((x - middle).astype(np.float64) - rest) @ w.weights


def identity_error(df: DataFrame, w: Whitening, vector: str = "embedding") -> float:
    """Largest entry of the covariance of the whitened vectors less the identity.

    A task sums products about its own mean; moving these to the mean of all is exact.
    """
    k, size, to_white = w.weights.shape[1], w.size, _whitened(w)
    if not k:
        return 0.0

    def add(batches):
        n, mean, m2 = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for piece in _rows(batch):
                for _, x in usable(piece.column("vector"), size)[1]:
                    z = to_white(x)
                    m, here = len(z), z.mean(axis=0)
                    z = z - here
                    away = here - mean
                    m2 += z.T @ z + np.outer(away, away) * (n * m / (n + m))
                    n, mean = n + m, mean + away * (m / (n + m))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n]), pa.array([mean.tolist()]), pa.array([m2.reshape(-1).tolist()])], names=["n", "mean", "m2"]
            )

    parts = _vectors(df, vector).mapInArrow(add, "n long, mean array<double>, m2 array<double>")
    parts = Scratch(df.sparkSession, "whitening").keep(parts, "parts")
    mean = parts.select(*(F.sum(F.col("n") * F.col("mean")[i]) / w.n for i in range(k))).first()
    off = [F.col("mean")[i] - F.lit(mean[i]) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = parts.select(
        *(F.sum(F.col("m2")[i * k + j] + F.col("n") * off[i] * off[j]) / w.n for i, j in pairs)
    ).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def transform(df: DataFrame, w: Whitening, vector: str = "embedding") -> DataFrame:
    """Usable rows as ``_row`` (all columns but the vector) with ``deviation`` and ``whitened``.

    ``deviation`` is the sum over dimensions of (n x - S)^2, exact, as text of a whole
    number; ``whitened`` has a number for each component. Repeated rows are rows of their own, in a
    table without usable vectors there are none.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c != vector] or [F.lit(0).alias("_")]
    rows = df.select(
        F.struct(*rest).alias("_row"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    kind = rows.schema["_row"].dataType.simpleString()
    size, to_white = w.size, _whitened(w) if w.n else None

    def work(batches):
        for batch in batches:
            for piece in _rows(batch):
                for at, x in usable(piece.column("vector"), size)[1] if w.n else ():
                    away = [w.n * x[:, i].astype(object) - w.total[i] for i in range(size)]
                    deviation = sum(a * a for a in away)
                    z = to_white(x)
                    yield pa.RecordBatch.from_arrays(
                        [
                            piece.column("_row").take(pa.array(at)),
                            pa.array([str(v) for v in deviation], pa.string()),
                            pa.ListArray.from_arrays(
                                pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), pa.array(z.reshape(-1))
                            ),
                        ],
                        names=["_row", "deviation", "whitened"],
                    )

    return rows.mapInArrow(work, f"_row {kind}, deviation string, whitened array<double>")


def whitened_components(df: DataFrame, vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: ``_row``, ``component`` (from 1), ``n``,
    ``deviation`` (as text), ``whitened``, ``explained`` and ``identity_error``. See ``fit`` for
    what is left out."""
    w = fit(df, vector, count)
    error = identity_error(df, w, vector)
    share = F.array(*(F.lit(e) for e in w.explained)).cast("array<double>")
    return (
        transform(df, w, vector)
        .select("_row", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            "_row",
            (F.col("at") + 1).alias("component"),
            F.lit(w.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            share[F.col("at")].alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
