"""Whitening of embeddings by an exact, bit-sliced scatter matrix.

Entries are cut to whole numbers. The whole numbers of a dimension, shifted to start at
zero, are taken apart into bit planes across rows, 64 rows a word; the weighted number of
common bits of two planes is an exact cross-product. The sums are centred as integers of
any length and only then divided, so the eigenvectors rest on no rounded sum.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm.common import saved

SCALE = 256
COMPONENTS = 4
# Vectors of more entries are refused: the scatter of one length is held by the driver.
MAX_DIMENSIONS = 2048

_ROWS = 2048  # rows of a block of bit planes
_DIGIT = 32  # a cross-product travels as digits of this many bits
_EXACT = 1 << 62
_LIMITS = "size int, dim int, low long, high long"
_SCATTER = "size int, a int, b int, place int, digit long"


@dataclass(frozen=True)
class Whitening:
    """What turns vectors of one length into whitened ones; bounded by the dimensions."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray  # dimensions x components
    values: np.ndarray  # eigenvalues of the components
    explained: np.ndarray

    def project(self, rows: np.ndarray) -> np.ndarray:
        """Whitened components of integer rows; not a number where a component has no spread."""
        low, high = int(rows.min(initial=0)), int(rows.max(initial=0))
        if max(-low, high) * self.n + max(map(abs, self.sums), default=0) < _EXACT:
            centred = (rows * self.n - np.array(self.sums, np.int64)).astype(np.float64)
        else:
            centred = np.array([[x * self.n - s for x, s in zip(row, self.sums)] for row in rows.tolist()], np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            return (centred / self.n) @ self.axes / np.where(self.values > 0, np.sqrt(self.values), np.nan)

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)^2 of each row, exactly; None if it is over 64 bits."""
        most = max(-int(rows.min(initial=0)), int(rows.max(initial=0))) * self.n + max(map(abs, self.sums), default=0)
        if most * most * max(len(self.sums), 1) < _EXACT:
            centred = rows * self.n - np.array(self.sums, np.int64)
            return (centred * centred).sum(1).tolist()
        exact = (sum((x * self.n - s) ** 2 for x, s in zip(row, self.sums)) for row in rows.tolist())
        return [value if value < 1 << 63 else None for value in exact]


def integer_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and x, whole numbers, of the rows whose vector is there and finite throughout.

    A number beyond 64 bits becomes the nearest one within.
    """
    finite = "forall(embedding, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('Infinity'))"
    cut = f"transform(embedding, v -> floor(CAST({scale} AS double) * CAST(v AS double)))"
    return rows.where(f"embedding IS NOT NULL AND {finite}").selectExpr("vec_id", f"{cut} AS x")


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of a batch by length: their numbers and an integer matrix."""
    column = batch.column("x")
    lengths = np.diff(column.offsets.to_numpy())
    flat, starts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()[:-1]
    for size in np.unique(lengths):
        chosen = np.flatnonzero(lengths == size)
        yield chosen, flat[starts[chosen][:, None] + np.arange(size)].astype(np.int64)


def _limits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least and largest number of each dimension, of the rows of a task."""
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for _, matrix in _matrices(batch):
            size, low, high = matrix.shape[1], matrix.min(0), matrix.max(0)
            if size in found:
                low, high = np.minimum(low, found[size][0]), np.maximum(high, found[size][1])
            found[size] = low, high
    for size, (low, high) in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(size, size, np.int32)), pa.array(np.arange(size, dtype=np.int32)), pa.array(low), pa.array(high)],
            names=["size", "dim", "low", "high"],
        )


def bit_planes(shifted: np.ndarray, widths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes across the rows of a matrix of unsigned numbers, packed 64 rows a word.

    Returns the planes, and the dimension and the weight (as a power of two) of each.
    Behind the dimensions stands one that is 1 in every row: its products are sums and count.
    """
    rows, size = shifted.shape
    words = -(-rows // 64)
    bits = np.zeros((sum(widths) + 1, words * 64), np.uint8)
    dims = np.repeat(np.arange(size + 1), [*widths, 1])
    powers = np.concatenate([np.arange(width) for width in widths] + [np.zeros(1, np.int64)])
    for plane, (dim, power) in enumerate(zip(dims[:-1], powers[:-1])):
        bits[plane, :rows] = (shifted[:, dim] >> np.uint64(power)).astype(np.uint8) & 1
    bits[-1, :rows] = 1
    return np.packbits(bits, axis=1).view(np.uint64), dims, powers


def plane_products(planes: np.ndarray, dims: np.ndarray, powers: np.ndarray, digits: np.ndarray) -> None:
    """Add the cross-products of dimensions, in order, to their digits.

    `digits[place, a, b]` counts in units of 2^(32 * place).
    """
    for plane in range(len(planes)):
        first = np.searchsorted(dims, dims[plane])
        common = np.bitwise_count(planes[first:] & planes[plane]).sum(1, dtype=np.int64)
        weight = powers[plane] + powers[first:]
        np.add.at(digits, (weight // _DIGIT, dims[plane], dims[first:]), common << (weight % _DIGIT))


# So many rows keep a digit (64 weights of up to 2^31) within 64 bits.
_FLUSH = 1 << 24


def _digit_rows(size: int, digits: np.ndarray) -> pa.RecordBatch:
    place, a, b = np.nonzero(digits)
    arrays = [np.full(len(a), size, np.int32), a.astype(np.int32), b.astype(np.int32), place.astype(np.int32), digits[place, a, b]]
    return pa.RecordBatch.from_arrays([pa.array(values) for values in arrays], names=["size", "a", "b", "place", "digit"])


def _scatter(limits: dict[int, tuple[np.ndarray, list[int]]]):
    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, list[int]]] = {}
        for batch in batches:
            for _, matrix in _matrices(batch):
                size = matrix.shape[1]
                low, widths = limits[size]
                if size not in sums:
                    places = 2 * max(max(widths) - 1, 0) // _DIGIT + 1
                    sums[size] = np.zeros((places, size + 1, size + 1), np.int64), [0]
                digits, seen = sums[size]
                for start in range(0, len(matrix), _ROWS):
                    # Unsigned differences are right even if the signed ones don't fit.
                    shifted = matrix[start : start + _ROWS].astype(np.uint64) - low.astype(np.uint64)
                    plane_products(*bit_planes(shifted, widths), digits)
                    seen[0] += len(shifted)
                    if seen[0] >= _FLUSH:
                        yield _digit_rows(size, digits)
                        digits[:], seen[0] = 0, 0
        for size, (digits, _) in sums.items():
            yield _digit_rows(size, digits)

    return of_batches


def _ratio(a: int, b: int) -> float:
    """a / b, rounded once."""
    return a / b


def solved(low: np.ndarray, products: dict[tuple[int, int], int], components: int) -> Whitening:
    """The whitening of one length, out of exact cross-products of shifted dimensions."""
    size = len(low)
    n = products[size, size]
    shifted = [products.get((dim, size), 0) for dim in range(size)]
    covariance = np.zeros((size, size))
    for a in range(size):
        for b in range(a, size):
            centred = n * products.get((a, b), 0) - shifted[a] * shifted[b]
            covariance[a, b] = covariance[b, a] = _ratio(centred, n * n)
    trace = sum(n * products.get((a, a), 0) - shifted[a] ** 2 for a in range(size))
    values, axes = np.linalg.eigh(covariance)
    chosen = np.argsort(-values, kind="stable")[:components]
    values, axes = values[chosen], axes[:, chosen]
    # Below this an eigenvalue is what rounding leaves of zero.
    values = np.where(values > size * np.finfo(float).eps * values.max(initial=0), values, 0.0)
    largest = np.abs(axes).argmax(0)
    axes = axes * np.where(axes[largest, np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    whole = _ratio(trace, n * n)
    sums = tuple(total + n * int(first) for total, first in zip(shifted, low.tolist()))
    return Whitening(n, sums, axes, values, values / whole if whole else np.zeros(len(values)))


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of each length of vectors in a written frame with a column x."""
    longest = fit_list.agg(F.max(F.size("x"))).first()[0] or 0
    if longest > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {longest} entries, at most {MAX_DIMENSIONS} are whitened")
    found = fit_list.mapInArrow(_limits, _LIMITS).groupBy("size", "dim").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    lows: dict[int, np.ndarray] = {}
    limits: dict[int, tuple[np.ndarray, list[int]]] = {}
    for row in sorted(found.collect(), key=lambda row: (row["size"], row["dim"])):
        low, widths = limits.setdefault(row["size"], (np.zeros(row["size"], np.int64), []))
        low[row["dim"]] = row["low"]
        widths.append((row["high"] - row["low"]).bit_length())
    lows = {size: low for size, (low, _) in limits.items()}
    digits = fit_list.mapInArrow(_scatter(limits), _SCATTER).groupBy("size", "a", "b", "place")
    totals = digits.agg(F.sum(F.col("digit").cast("decimal(20,0)")).alias("digit")).toArrow()
    products: dict[int, dict[tuple[int, int], int]] = {size: {} for size in lows}
    for size, a, b, place, digit in zip(*(column.to_pylist() for column in totals.columns)):
        products[size][a, b] = products[size].get((a, b), 0) + (int(digit) << (_DIGIT * place))
    return {size: solved(low, products[size], components) for size, low in lows.items()}


def identity_error(fit_list: DataFrame, models: dict[int, Whitening]) -> float | None:
    """Largest entry of (covariance of the whitened fit list - identity), over all lengths.

    Measured on the rows; components without spread are left out. None if there is no row.
    """
    if not models:
        return None
    columns = max(len(model.values) for model in models.values())
    names = [f"w{i}" for i in range(columns)]
    shared = fit_list.sparkSession.sparkContext.broadcast(models)

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, matrix in _matrices(batch):
                whitened = shared.value[matrix.shape[1]].project(matrix)
                arrays = [pa.array(np.full(len(matrix), matrix.shape[1], np.int32))]
                arrays += [pa.array(whitened[:, i].copy(), mask=np.isnan(whitened[:, i])) for i in range(whitened.shape[1])]
                arrays += [pa.nulls(len(matrix), pa.float64())] * (columns - whitened.shape[1])
                yield pa.RecordBatch.from_arrays(arrays, names=["size", *names])

    rows = fit_list.mapInArrow(of_batches, "size int, " + ", ".join(f"{name} double" for name in names))
    pairs = [(i, j) for i in range(columns) for j in range(i, columns)]
    found = rows.groupBy("size").agg(*(F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs))
    errors = [
        abs(row[f"c{i}_{j}"] - (1.0 if i == j else 0.0)) for row in found.collect() for i, j in pairs if row[f"c{i}_{j}"] is not None
    ]
    return max(errors, default=0.0)


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Whitened components of the vectors in `embedding`, one row per row and component.

    Returns vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened,
    explained and identity_error. The fit list is each distinct cut vector once.

    Rows whose vector is null or has null or non-finite entries are left out; a null
    vec_id stays. Repeated rows each count in the result and once in the fit. Vectors of
    different lengths are whitened among their own length, one of length 0 has no component
    and no row. A component without any spread (fewer distinct vectors than dimensions,
    equal entries, a single vector) has a null `whitened` and explains 0. A deviation over
    64 bits is null. Other columns are ignored, an empty table gives no rows.
    """
    spark = rows.sparkSession
    usable = saved(integer_vectors(rows, scale).where("size(x) > 0"), "whitening-vectors")
    fit_list = saved(usable.select("x").distinct(), "whitening-fit")
    models = fit(fit_list, components)
    error = identity_error(fit_list, models)
    shared = spark.sparkContext.broadcast(models)
    id_type = usable.schema["vec_id"].dataType

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chosen, matrix in _matrices(batch):
                model = shared.value[matrix.shape[1]]
                k = len(model.values)
                ids = batch.column("vec_id").take(pa.array(np.repeat(chosen, k)))
                whitened = model.project(matrix).ravel()
                deviations = pa.array(model.deviations(matrix), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(matrix))),
                        pa.array(np.full(len(ids), model.n, np.int64)),
                        deviations.take(pa.array(np.repeat(np.arange(len(matrix)), k))),
                        pa.array(whitened, mask=np.isnan(whitened)),
                        pa.array(np.tile(model.explained, len(matrix))),
                        pa.array(np.full(len(ids), 0.0 if error is None else error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    schema = f"vec_id {id_type.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return usable.mapInArrow(of_batches, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every embedding."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
