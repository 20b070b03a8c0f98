"""Embedding whitening by polarisation: cross-covariances from the variances of pair sums, all sums exact."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.session import written

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
LARGEST = 2.0**56
"""Entries of this size or more have no 64-bit grid value."""
LIMBS, LIMB_BITS = 5, 40
"""Squares of sums of two grid values, over up to 2^40 rows in up to 2^23 tasks, fit these limbs."""
SMALLEST = 1_000 * 2.0**-52
"""Times the number of dimensions: eigenvalues below this share of the largest are rounding, not components."""
_AT_ONCE = 1 << 20
"""Array entries that a task works on at once."""


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` distinct grid vectors: their exact sums, and the components by falling eigenvalue.

    ``vectors`` has one row per component; ``values`` are the eigenvalues and ``trace`` is the sum of all of
    them, also of those not kept.
    """

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def middle(self) -> list[int]:
        """The whole number next to each mean."""
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    @property
    def rest(self) -> list[int]:
        """What ``sums`` has beyond n times ``middle``: at most n / 2 either way."""
        return [s - self.n * m for s, m in zip(self.sums, self.middle)]


def usable(vector: Column, size: int) -> Column:
    """Whether a vector has ``size`` entries, all of them numbers that the grid holds."""
    whole = F.forall(vector, lambda e: F.coalesce(F.abs(e.cast("double")) < LARGEST, F.lit(False)))
    return F.coalesce((F.size(vector) == size) & whole, F.lit(False))


def gridded(embeddings: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """The rows with a usable vector, with it as whole numbers in ``x``; and the number of dimensions.

    That number is the commonest length among the vectors, the longest of equally common ones. Vectors of
    another length lack entries or have some too many and are left out, like those with a null,
    a non-finite or an out-of-grid entry.
    """
    sizes = embeddings.groupBy(F.size(F.col(column)).alias("size")).agg(F.count(F.lit(1)).alias("n")).where("size > 0")
    common = sizes.agg(F.max(F.struct("n", "size")).alias("top")).first()["top"]
    size = common["size"] if common else 0
    x = F.transform(F.col(column), lambda e: F.floor(e.cast("double") * SCALE) + SHIFT)
    return embeddings.where(usable(F.col(column), size)).withColumn("x", x), size


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column whose lists all have ``size`` entries and no nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def limbs(total: int) -> list[int]:
    """Base 2^40 digits; the last one carries the sign. Lists of digits add up digit by digit."""
    low = [(total >> (LIMB_BITS * k)) & ((1 << LIMB_BITS) - 1) for k in range(LIMBS - 1)]
    return [*low, total >> (LIMB_BITS * (LIMBS - 1))]


def from_limbs(digits: list[int]) -> int:
    return sum(int(d) << (LIMB_BITS * k) for k, d in enumerate(digits))


def exact_sums(rows: DataFrame, entries, size: int) -> dict[int, int]:
    """Per entry the exact sum over all rows; ``entries(x)`` yields (first index, sums of a block of rows).

    Each task adds up its rows in Python whole numbers, the tasks' digits are summed in Spark, and the
    driver gets one row per entry.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, int] = {}
        step = max(1, _AT_ONCE // max(size, 1))
        for batch in batches:
            x = matrix(batch.column("x"), size)
            for start in range(0, len(x), step):
                for first, sums in entries(x[start : start + step]):
                    for k, s in enumerate(sums, first):
                        totals[k] = totals.get(k, 0) + int(s)
        yield pa.RecordBatch.from_pydict({
            "entry": pa.array(list(totals), pa.int64()),
            "digits": pa.array([limbs(t) for t in totals.values()], pa.list_(pa.int64())),
        })

    partial = rows.select("x").mapInArrow(add, "entry long, digits array<long>")
    summed = partial.groupBy("entry").agg(F.array(*[F.sum(F.col("digits")[k]) for k in range(LIMBS)]).alias("digits"))
    return {r["entry"]: from_limbs(r["digits"]) for r in summed.collect()}


def whole(values: np.ndarray, largest: int) -> np.ndarray:
    """``values`` as machine numbers while ``largest`` shows that nothing overflows, else as Python's."""
    return values if largest < 2**62 else values.astype(object)


def centred(x: np.ndarray, middle: list[int]) -> np.ndarray:
    spread = max((max(abs(int(x[:, j].max()) - m), abs(int(x[:, j].min()) - m)) for j, m in enumerate(middle)), default=0) if len(x) else 0
    z = whole(x, spread) - np.array(middle, dtype=np.int64 if spread < 2**62 else object)
    return whole(z, 4 * spread * spread * max(len(x), 1))


def squares(x: np.ndarray, middle: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Sums of the squared centred values of every dimension, then of every sum of two dimensions, in order."""
    z = centred(x, middle)
    size = z.shape[1]
    yield 0, (z * z).sum(axis=0)
    first = size
    for j in range(size - 1):
        pair = z[:, j + 1 :] + z[:, j : j + 1]
        yield first, (pair * pair).sum(axis=0)
        first += size - 1 - j


def covariance(n: int, rest: list[int], sums: dict[int, int]) -> np.ndarray:
    """The covariance matrix, each entry rounded once.

    With v a dimension or a sum of two, m the whole number it was centred on and R = sum(v - m), the sum of
    (n v - sum(v))^2 is n^2 sum((v - m)^2) - n R^2. Half of what the variance of j + k has beyond those of
    j and k is their covariance.
    """
    size = len(rest)
    variances = [n * n * sums[j] - n * rest[j] ** 2 for j in range(size)]
    out = np.zeros((size, size))
    entry = size
    for j in range(size):
        out[j, j] = variances[j] / n**3
        for k in range(j + 1, size):
            both = n * n * sums[entry] - n * (rest[j] + rest[k]) ** 2
            out[j, k] = out[k, j] = (both - variances[j] - variances[k]) / (2 * n**3)
            entry += 1
    return out


def fit(distinct: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """Components of ``distinct(x)``, every vector once; None without rows.

    Two passes: exact sums, then exact squares about the whole numbers next to the means. The driver holds
    numbers of the order of dimensions squared, whatever the number of rows.
    """
    def plain(x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        yield 0, whole(x, int(np.abs(x.astype(float)).max()) * len(x)).sum(axis=0)
        yield size, np.array([len(x)])

    sums = exact_sums(distinct, plain, size)
    n = sums.pop(size, 0)
    if not n:
        return None
    totals = tuple(sums[j] for j in range(size))
    known = Whitening(n, totals, np.zeros(0), np.zeros((0, size)), 0.0)
    middle = known.middle
    v = covariance(n, known.rest, exact_sums(distinct, lambda x: squares(x, middle), size))
    values, vectors = np.linalg.eigh(v)
    order = [k for k in np.argsort(-values, kind="stable") if values[k] > 0 and values[k] > SMALLEST * size * values[-1]]
    kept = order[:components]
    return Whitening(n, totals, values[kept], vectors[:, kept].T.copy(), float(np.trace(v)))


def projected(z: np.ndarray, fitted: Whitening) -> np.ndarray:
    """Whitened coordinates of centred rows: (rows, components)."""
    offset = np.array([r / fitted.n for r in fitted.rest])
    return (z.astype(np.float64) - offset) @ (fitted.vectors / np.sqrt(fitted.values)[:, None]).T


def identity_error(distinct: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened fit rows' covariance minus the identity, measured on them."""
    size, kept = len(fitted.sums), len(fitted.values)
    middle = fitted.middle

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((kept, kept))
        step = max(1, _AT_ONCE // size)
        for batch in batches:
            x = matrix(batch.column("x"), size)
            for start in range(0, len(x), step):
                w = projected(centred(x[start : start + step], middle), fitted)
                total += w.T @ w
        yield pa.RecordBatch.from_pydict({"entry": pa.array(range(kept * kept), pa.int64()), "sum": pa.array(total.reshape(-1))})

    sums = distinct.select("x").mapInArrow(add, "entry long, sum double").groupBy("entry").agg(F.sum("sum").alias("sum"))
    measured = np.zeros(kept * kept)
    for row in sums.collect():
        measured[row["entry"]] = row["sum"] / fitted.n
    return float(np.abs(measured.reshape(kept, kept) - np.eye(kept)).max()) if kept else 0.0


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error per usable row and component.

    Each entry c becomes floor(64 c) + 1000000. The fit list holds each distinct vector of such numbers
    once, so a vector that a third of the rows share counts once and, combined in every task first, travels once
    per task. Covariances rest on exact sums (see ``covariance``); components are numbered from 1 by falling
    eigenvalue, up to ``components``.

    Rows without a usable vector (see ``gridded``) are left out. Repeated rows come out each; null ids stay null.
    Directions without variance are no components: one distinct vector, or an empty table, gives no rows.
    ``deviation`` is null where it is beyond a long. Vectors of any length work, at a cost of the square
    of it per row; other columns are ignored.
    """
    rows, size = gridded(embeddings)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x")
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    distinct = written(rows.select("x").distinct(), "whitening-fit")
    fitted = fit(distinct, size, components) if size else None
    if fitted is None or not len(fitted.values):
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(distinct, fitted)
    middle, rest, n = fitted.middle, np.array(fitted.rest, dtype=object), fitted.n
    kept = len(fitted.values)
    explained = fitted.values / fitted.trace
    largest_rest = max(abs(int(r)) for r in rest)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, _AT_ONCE // max(size, kept))
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, step):
                batch = whole_batch.slice(start, step)
                z = centred(matrix(batch.column("x"), size), middle)
                largest = n * max(abs(int(z.max())), abs(int(z.min()))) + largest_rest
                fits = size * largest * largest < 2**63
                y = z.astype(np.int64 if fits else object) * n - (rest.astype(np.int64) if fits else rest)
                deviations = [int(d) for d in (y * y).sum(axis=1)]
                deviation = pa.array([d if d < 2**63 else None for d in deviations], pa.int64())
                each = np.repeat(np.arange(batch.num_rows), kept)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch.column("vec_id").take(pa.array(each)),
                    "component": pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), batch.num_rows)),
                    "n": pa.array(np.full(len(each), n, np.int64)),
                    "deviation": deviation.take(pa.array(each)),
                    "whitened": pa.array(projected(z, fitted).reshape(-1)),
                    "explained": pa.array(np.tile(explained, batch.num_rows)),
                    "identity_error": pa.array(np.full(len(each), error)),
                })

    return rows.mapInArrow(project, schema)
