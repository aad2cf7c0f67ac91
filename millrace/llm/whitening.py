"""Embedding whitening by a compensated covariance.

Vectors are put on an integer grid, and the model is fitted to the distinct ones.

1. Sums: each task adds its integers; Spark adds those of all tasks.
2. Covariance: each task centres its vectors (as a high and a low double), splits
   products into rounded value and error without loss, and adds both parts in
   double-double, pairwise within a block and block after block.  A task's result
   is a matrix of high and one of low parts, given out row by row; the rows are
   dealt out by their number and merged in double-double again.
3. The covariance goes to the driver, which is one matrix whatever the number of
   vectors, and is taken apart by a tridiagonal divide-and-conquer solver (LAPACK's
   ``syevd``, which :func:`numpy.linalg.eigh` calls).
4. Means and components go out to all tasks, which project every vector.  How far
   the covariance of what they give is from the identity is measured in one more
   pass over the fitted vectors, by step 2.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import bound_batches, store, tidy

COMPONENTS = 16
BLOCK = 1 << 18  # products held at once in one array
LEAST = 1e-13  # components with less than this share of the largest variance are rounding and have no direction
_SPLIT = float((1 << 27) + 1)
_PARTIAL = "line int, high array<double>, low array<double>"


def on_grid(vector, scale: int = 64, offset: int = 1_000_000):
    """floor(scale * x) + offset of each component; null for a vector that takes no part."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(wide, lambda x: F.floor(x * scale).cast("long") + offset)
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), whole)


# double-double: a value is the unevaluated sum of a high and a low part


def two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rounded sum and its error."""
    total = a + b
    back = total - a
    return total, (a - (total - back)) + (b - back)


def add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sum of two double-doubles, normalised."""
    high, error = two_sum(a[0], b[0])
    low, more = two_sum(a[1], b[1])
    error = error + low
    total = high + error
    error = error - (total - high) + more
    high = total + error
    return high, error - (high - total)


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of 26 bits whose products with others are exact."""
    wide = a * _SPLIT
    upper = wide - (wide - a)
    return upper, a - upper


def two_product(a: np.ndarray, b: np.ndarray, a_halves, b_halves) -> tuple[np.ndarray, np.ndarray]:
    """The rounded product and its error, from the factors' halves."""
    product = a * b
    error = ((a_halves[0] * b_halves[0] - product) + a_halves[0] * b_halves[1] + a_halves[1] * b_halves[0]) + a_halves[1] * b_halves[1]
    return product, error


def add_rows(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of all rows of a double-double array, pairwise."""
    while len(high) > 1:
        half = len(high) // 2
        odd = slice(2 * half, None)
        a, b = add((high[:half], low[:half]), (high[half : 2 * half], low[half : 2 * half]))
        high, low = np.concatenate([a, high[odd]]), np.concatenate([b, low[odd]])
    return high[0], low[0]


class Moments:
    """Sums of outer products of centred vectors, in double-double, upper triangle only."""

    def __init__(self, width: int):
        self.width, self.upper = width, np.triu_indices(width)
        self.total = np.zeros(len(self.upper[0])), np.zeros(len(self.upper[0]))
        self.rows = 0

    def add(self, high: np.ndarray, low: np.ndarray) -> None:
        """Centred vectors by their high and low parts."""
        i, j = self.upper
        step = max(1, BLOCK // max(1, len(i)))
        for at in range(0, len(high), step):
            a, b = high[at : at + step], low[at : at + step]
            upper, lower = split(a)
            products, errors = two_product(a[:, i], a[:, j], (upper[:, i], lower[:, i]), (upper[:, j], lower[:, j]))
            errors += a[:, i] * b[:, j] + b[:, i] * a[:, j]
            self.total = add(self.total, add_rows(products, errors))
            self.rows += len(a)

    def lines(self) -> pa.RecordBatch:
        """Row by row of the matrix, from the diagonal on."""
        ends = np.concatenate([[0], np.cumsum(np.arange(self.width, 0, -1))]).astype(np.int32)
        arrays = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in self.total]
        return pa.record_batch({"line": np.arange(self.width, dtype=np.int32), "high": arrays[0], "low": arrays[1]})


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the lines of all tasks; one line of each number is held."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for at, line in enumerate(batch.column("line").to_pylist()):
            own = tuple(batch.column(c)[at].values.to_numpy() for c in ("high", "low"))
            held[line] = add(held[line], own) if line in held else own
    if held:
        lists = [pa.array([held[k][i] for k in held], pa.list_(pa.float64())) for i in (0, 1)]
        yield pa.record_batch({"line": np.array(list(held), np.int32), "high": lists[0], "low": lists[1]})


def covariance(fit: DataFrame, width: int, n: int, centre: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The covariance, divisor n, of what ``centre`` makes of the vectors, as a high and a low matrix of width x width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = Moments(width)
        for batch in batches:
            if batch.num_rows:
                moments.add(*centre(matrix(batch.column("vector"))))
        if moments.rows:
            yield moments.lines()

    merged = fit.mapInArrow(tidy(run), _PARTIAL).repartition("line").mapInArrow(tidy(_merge), _PARTIAL)
    high, low = np.zeros((width, width)), np.zeros((width, width))
    for row in merged.collect():  # width lines
        k = row["line"]
        high[k, k:], low[k, k:] = row["high"], row["low"]
    # divide in double-double: quotient, then the remainder's quotient
    quotient = high / n
    product, error = two_product(quotient, np.full_like(quotient, float(n)), split(quotient), split(np.full_like(quotient, float(n))))
    rest = ((high - product) - error + low) / n
    quotient, rest = two_sum(quotient, rest)
    return tuple(np.triu(x) + np.triu(x, 1).T for x in (quotient, rest))


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of a list column of one width as 64-bit integers."""
    lengths = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy().reshape(len(column), int(lengths[0]) if len(lengths) else width)


@dataclass(frozen=True)
class Model:
    """What every task needs: n, sums, mean (high, low), components (as columns, already divided by the root of their variance)."""

    n: int
    sums: tuple[int, ...]
    mean: tuple[np.ndarray, np.ndarray]
    components: np.ndarray
    explained: np.ndarray

    def centred(self, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x - S/n as high and low part; grid values are exact as doubles up to 2**53."""
        high, low = two_sum(grid.astype(np.float64), -self.mean[0])
        return two_sum(high, low - self.mean[1])

    def whitened(self, grid: np.ndarray) -> np.ndarray:
        high, low = self.centred(grid)
        return high @ self.components + low @ self.components

    def deviation(self, grid: np.ndarray) -> np.ndarray:
        """The sum over dimensions of (n*x - S)**2, exactly; an error beyond 64 bits."""
        most = max((abs(int(grid.max(initial=0)) * self.n - s) for s in self.sums), default=0)
        most = max(most, max((abs(int(grid.min(initial=0)) * self.n - s) for s in self.sums), default=0), *map(abs, self.sums), abs(int(np.abs(grid).max(initial=0)) * self.n))
        if most * most * max(1, len(self.sums)) < 1 << 63:
            return ((grid * self.n - np.array(self.sums, np.int64)) ** 2).sum(axis=1)
        exact = [sum((x * self.n - s) ** 2 for x, s in zip(row, self.sums, strict=True)) for row in grid.tolist()]
        if max(exact, default=0) >= 1 << 63:
            raise OverflowError("a deviation does not fit in 64 bits")
        return np.array(exact, np.int64)


def learn(fit: DataFrame, components: int = COMPONENTS) -> tuple[Model | None, float]:
    """The model of the distinct grid vectors ``fit.vector``, and how far its result's covariance is from the identity."""
    sums = fit.mapInArrow(tidy(_sums), "place int, n long, total decimal(38,0)").groupBy("place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    if not sums:
        return None, 0.0
    sums = sorted((r["place"], r["n"], int(r["total"])) for r in sums)
    n, totals, width = sums[0][1], tuple(s[2] for s in sums), len(sums)
    high = np.array([t / n for t in totals])  # Python's division of integers is rounded correctly
    parts = [float(h).as_integer_ratio() for h in high]
    low = np.array([(t * q - p * n) / (n * q) for t, (p, q) in zip(totals, parts, strict=True)])
    bare = Model(n, totals, (high, low), np.zeros((width, 0)), np.zeros(0))
    v, rest = covariance(fit, width, n, bare.centred)
    values, vectors = np.linalg.eigh(v + rest)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > LEAST * max(values.max(), 0.0)]
    trace = np.trace(v) + np.trace(rest)
    made = Model(n, totals, (high, low), vectors[:, order] / np.sqrt(values[order]), values[order] / trace if trace > 0 else values[order])
    if not len(order):
        return made, 0.0
    # the mean of what comes out is that of centred integers, whose sum is n * (S/n - mean): below what a double tells from zero
    found = covariance(fit, len(order), n, lambda grid: (w := made.whitened(grid), np.zeros_like(w)))
    return made, float(np.abs(found[0] - np.eye(len(order)) + found[1]).max())


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            grid = matrix(batch.column("vector"))
            own = [int(x) for x in grid.sum(axis=0)] if np.abs(grid).max(initial=0) < (1 << 62) // len(grid) else [sum(c) for c in zip(*grid.tolist(), strict=True)]
            total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
            n += len(grid)
    if total:
        yield pa.record_batch({"place": np.arange(len(total), dtype=np.int32), "n": np.full(len(total), n), "total": pa.array(total, pa.decimal128(38, 0))})


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row and component: id_col, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null or non-finite entries have no result.
    A shorter vector counts as filled up with zeros to the longest.  Rows that
    repeat a vector, or its identifier, each have their results; a vector counts
    once in the fit however often it is repeated.  A null identifier stays null.
    Components are numbered from 1 by falling variance; those without variance
    (below ``LEAST`` of the largest) have no direction and are left out, so an
    empty table, empty vectors, or copies of one vector alone give an empty result.
    Equal variances may give any of the possible directions, the same for all
    rows.  Entries beyond 2**46 and deviations beyond 64 bits are errors.  Memory
    of a task and of the driver: some matrices of width x width.  Other columns
    are not read.
    """
    spark = vectors.sparkSession
    bound_batches(spark, rows=2000)
    rows = vectors.select(F.col(id_col).alias("id"), on_grid(F.col(vector_col)).alias("vector")).where("vector is not null")
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    rows = rows.withColumn("vector", F.concat("vector", F.array_repeat(F.lit(1_000_000).cast("long"), F.lit(width) - F.size("vector"))))
    fit = store(rows.select("vector").distinct(), "whitening")
    model, error = learn(fit, components)
    schema = f"id {dict(rows.dtypes)['id']}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = shared.value
        for batch in batches:
            if not batch.num_rows or made is None or not len(made.explained):
                continue
            grid = matrix(batch.column("vector"))
            many = len(made.explained)
            at = np.repeat(np.arange(len(grid)), many)
            yield pa.record_batch(
                {
                    "id": batch.column("id").take(pa.array(at)),
                    "component": np.tile(np.arange(1, many + 1, dtype=np.int32), len(grid)),
                    "n": np.full(len(at), made.n),
                    "deviation": made.deviation(grid)[at],
                    "whitened": made.whitened(grid).ravel(),
                    "explained": np.tile(made.explained, len(grid)),
                    "identity_error": np.full(len(at), error),
                }
            )

    return rows.mapInArrow(tidy(run), schema).withColumnRenamed("id", id_col)
