"""Embedding whitening by polarisation covariance.

Entries become whole numbers, so that every sum of the corpus is exact. One pass adds them up; the next adds
the squares of what is left after centring, for each dimension and for the sum of each pair of dimensions.
Half the difference between the variance of a sum and those of its parts is their covariance, so these
variances alone fill the matrix that `eigh` takes apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import batch, workers_import

SCALE, SHIFT, COMPONENTS = 1_024, 100_000, 8
#: Rows whose entries would pass this after scaling have no place among whole numbers that add up exactly.
LARGEST = 1 << 45
#: Centred values up to this bound have sums of squares over ROWS vectors that fit in 64 bits.
SMALL, ROWS = 1 << 24, 1_024
#: What is stored or moved of exact sums.
EXACT = pa.decimal128(38, 0)

SUMS = pa.schema([("size", pa.int32()), ("place", pa.int32()), ("n", pa.int64()), ("total", EXACT)])
SQUARES = pa.schema([("place", pa.int32()), ("total", EXACT)])
MOMENTS = pa.schema([("place", pa.int32()), ("total", pa.float64())])
WHITE = pa.schema(
    [("vec_id", pa.int64()), ("component", pa.int32()), ("deviation", EXACT), ("whitened", pa.float64())]
)


class Fit(NamedTuple):
    """The centre and covariance of n vectors of one dimension, and the components that have variance."""

    n: int
    #: Exact sums of each dimension.
    sums: list[int]
    #: One row for each component, of unit length, by falling eigenvalue.
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def whole_numbers(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, numbers) of usable vectors for each length that occurs, `SCALE` times the entry, rounded down, plus SHIFT.

    A vector that is null, has null or non-finite entries, or entries too large to add up exactly is left out.
    """
    sizes = np.array([-1 if s is None else s for s in pc.list_value_length(vectors).to_pylist()], np.int64)
    flat = vectors.flatten()
    entries = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    usable = np.isfinite(entries) & flat.is_valid().to_numpy(zero_copy_only=False)
    x = np.zeros(len(entries))
    x[usable] = np.floor(SCALE * np.clip(entries[usable], -LARGEST, LARGEST)) + SHIFT
    usable &= np.abs(x) < LARGEST
    starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    for size in np.unique(sizes[sizes >= 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        at = starts[rows][:, None] + np.arange(size)
        good = usable[at].all(axis=1)
        if good.any():
            yield rows[good], x[at[good]].astype(np.int64)


def _read(batches: Iterator[pa.RecordBatch], size: int | None = None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, numbers) of usable vectors, few at a time; with `size`, of that length only."""
    for part in batches:
        for at in range(0, part.num_rows, ROWS):
            some = part.slice(at, ROWS)
            for rows, x in whole_numbers(some.column(1)):
                if size is None or x.shape[1] == size:
                    yield some.column(0).take(pa.array(rows)), x


def _emit_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[int, np.ndarray]] = {}
    for _, x in _read(batches):
        n, total = held.get(x.shape[1], (0, np.zeros(x.shape[1], object)))
        held[x.shape[1]] = n + len(x), total + x.sum(axis=0).astype(object)
    for size, (n, total) in held.items():
        # The last place is there for vectors without any entry as well.
        yield batch(SUMS, [size] * (size + 1), range(size + 1), [n] * (size + 1), _exact([*total, 0]))


def _exact(values) -> list[Decimal]:
    return [Decimal(int(v)) for v in values]


def polarised(y: np.ndarray) -> Iterator[int]:
    """The exact sums of squares of each column of centred `y`, then of each sum of two columns, in order."""
    wide = y.astype(object) if len(y) and max(int(y.max(initial=0)), -int(y.min(initial=0))) > SMALL else y
    yield from (wide * wide).sum(axis=0)
    for i in range(y.shape[1] - 1):
        pair = wide[:, i + 1 :] + wide[:, i : i + 1]
        yield from (pair * pair).sum(axis=0)


def _emit_squares(centre: np.ndarray):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _read(batches, len(centre)):
            part = np.array([int(v) for v in polarised(x - centre)], object)
            total = part if total is None else total + part
        if total is not None:
            yield batch(SQUARES, range(len(total)), _exact(total))

    return emit


def covariance(n: int, sums: list[int], squares: list[int]) -> np.ndarray:
    """The covariance matrix, divisor n, of n vectors. `squares` are sums over x less `centre_of`, as `polarised` has them.

    All is exact until the last division: with y = x - c and r = S - n c, the sum of (n x - S)^2 is n^2 times that
    of y^2, less n r^2.
    """
    size = len(sums)
    rest = [s - n * c for s, c in zip(sums, centre_of(n, sums), strict=True)]
    deviation = [n * n * q - n * r * r for q, r in zip(squares[:size], rest, strict=True)]
    out = np.zeros((size, size))
    at = size
    for i in range(size):
        out[i, i] = Fraction(deviation[i], n**3)
        for j in range(i + 1, size):
            of_sum = n * n * squares[at] - n * (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = Fraction(of_sum - deviation[i] - deviation[j], 2 * n**3)
            at += 1
    return out


def centre_of(n: int, sums: list[int]) -> list[int]:
    """The mean of each dimension, rounded down."""
    return [s // n for s in sums]


def components_of(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(unit eigenvectors as rows, eigenvalues) by falling eigenvalue; the entry of greatest size is positive.

    Those whose eigenvalue is nothing but rounding are left out.
    """
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:most], vectors.T[::-1][:most]
    real = values > len(matrix) * np.finfo(float).eps * max(float(values.max(initial=0)), 0.0)
    values, vectors = values[real], vectors[real]
    largest = np.take_along_axis(vectors, np.abs(vectors).argmax(axis=1)[:, None], axis=1)
    return vectors * np.where(largest < 0, -1.0, 1.0), values


def fit(embeddings: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> Fit | None:
    """The whitening of all usable vectors of the commonest length (the longer of equally common ones), None if there are none.

    What comes to the driver is a number for each dimension and each pair of dimensions.
    """
    spark = embeddings.sparkSession
    workers_import(spark)
    slim = embeddings.select(F.lit(None).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    sums = (
        slim.mapInArrow(_emit_sums, "size int, place int, n long, total decimal(38,0)")
        .groupBy("size", "place")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    chosen = sums.filter("place = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if chosen is None:
        return None
    n, size = chosen["n"], chosen["size"]
    rows = sums.filter((F.col("size") == size) & (F.col("place") < size)).collect()
    of_place = {row["place"]: int(row["total"]) for row in rows}
    total = [of_place[place] for place in range(size)]
    if not size:
        return Fit(n, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    centre = np.array(centre_of(n, total), np.int64)
    squares = (
        slim.mapInArrow(_emit_squares(centre), "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total"))
    )
    of_place = {place: int(value) for place, value in squares.collect()}
    matrix = covariance(n, total, [of_place[place] for place in range(size * (size + 1) // 2)])
    components, values = components_of(matrix, most)
    return Fit(n, total, components, values, float(np.trace(matrix)))


def _projected(model: Fit, x: np.ndarray) -> np.ndarray:
    """Whitened rows: x less the mean, which is split into whole and rest so that nothing is lost, along the components."""
    centre = centre_of(model.n, model.sums)
    rest = np.array([float(Fraction(s - model.n * c, model.n)) for s, c in zip(model.sums, centre, strict=True)])
    centred = (x - np.array(centre, np.int64)) - rest
    return centred @ model.components.T / np.sqrt(model.eigenvalues)


def deviations(model: Fit, x: np.ndarray) -> list[int]:
    """The exact sum over dimensions of (n x - S)^2 of each row."""
    centre = centre_of(model.n, model.sums)
    rest = [s - model.n * c for s, c in zip(model.sums, centre, strict=True)]
    y = x - np.array(centre, np.int64)
    largest = max(int(np.abs(y).max(initial=0)), *rest)
    if largest * largest * len(rest) >= 1 << 63:
        y = y.astype(object)
    squares, products = (y * y).sum(axis=1).tolist(), (y * np.array(rest, y.dtype)).sum(axis=1).tolist()
    own = sum(r * r for r in rest)
    return [model.n**2 * int(q) - 2 * model.n * int(p) + own for q, p in zip(squares, products, strict=True)]


def _emit_moments(model: Fit):
    k = len(model.eigenvalues)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, seen = np.zeros(k), np.zeros((k, k)), False
        for _, x in _read(batches, len(model.sums)):
            white = _projected(model, x)
            first, second, seen = first + white.sum(axis=0), second + white.T @ white, True
        if seen:
            yield batch(MOMENTS, range(k + k * k), np.concatenate([first, second.ravel()]))

    return emit


def identity_error(embeddings: DataFrame, model: Fit, vector: str = "embedding") -> float:
    """The largest absolute entry of the covariance of all whitened rows, less the identity, measured on the rows."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0
    slim = embeddings.select(F.lit(None).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    sums = slim.mapInArrow(_emit_moments(model), "place int, total double").groupBy("place").agg(F.sum("total"))
    of_place = dict(map(tuple, sums.collect()))
    mean = np.array([of_place[i] for i in range(k)]) / model.n
    second = np.array([of_place[i] for i in range(k, k + k * k)]).reshape(k, k) / model.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def _emit_white(model: Fit):
    k = len(model.eigenvalues)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _read(batches, len(model.sums)):
            n = len(x)
            deviation = [None if v >= 10**38 else Decimal(v) for v in deviations(model, x)]
            yield batch(
                WHITE,
                ids.take(pa.array(np.repeat(np.arange(n), k))),
                np.tile(np.arange(1, k + 1, dtype=np.int32), n),
                [v for v in deviation for _ in range(k)],
                _projected(model, x).ravel(),
            )

    return emit


def whitened(
    embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), up to `components` rows for each usable vector.

    Left out are vectors that are null, hold a null or non-finite entry or one beyond 3.4e10 in size (whose
    whole numbers could not be added up exactly), or are of another length than most. A component without
    variance is left out, so one vector, or copies of one alone, give no rows. Null ids stay null, repeated
    rows count and appear as often as they occur, an empty table gives no rows, other columns are not read.
    `deviation` is exact, null beyond 38 digits.
    """
    spark = embeddings.sparkSession
    model = fit(embeddings, vector, components)
    schema = "vec_id long, component int, deviation decimal(38,0), whitened double"
    if model is None or not len(model.eigenvalues):
        rows, error, explained = spark.createDataFrame([], schema), 0.0, [0.0]
    else:
        slim = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
        rows, error = slim.mapInArrow(_emit_white(model), schema), identity_error(embeddings, model, vector)
        explained = (model.eigenvalues / model.trace).tolist()
    of_component = F.array(*map(F.lit, explained))[F.col("component") - 1]
    return rows.select(
        "vec_id",
        "component",
        F.lit(0 if model is None else model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        of_component.alias("explained"),
        F.lit(error).alias("identity_error"),
    )
