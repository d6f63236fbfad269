"""Whitening of vectors with eigenvalues found by slicing the spectrum.

One pass sums the components, a second one the products of components after a whole number near the mean is taken from
each; both sums are whole and exact. By Sylvester's law a shifted covariance has as many negative pivots in its LDLᵀ
factors as eigenvalues below the shift. Bisection on these counts isolates each leading eigenvalue, Rayleigh quotient
iteration converges from there, and counts on both sides of the result certify its number.

The driver holds the covariance, dimensions squared, and nothing that grows with the rows.

Defined results. Rows whose vector is null, empty or holds nulls or numbers that aren't finite are left out, as are
vectors whose length isn't the most frequent one (of two, the greater): a covariance has one set of dimensions. Components
without variance can't be scaled to one and are left out, so there may be fewer than asked for, also none. Rows that
share an id are vectors of their own. A deviation beyond the range of a long is null. Extra columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import batch_settings
from matchloom.storage import materialize

Batches = Iterator[pa.RecordBatch]
EXACT = 1 << 53


def inertia(matrix: np.ndarray) -> int:
    """Negative eigenvalues of a symmetric matrix, counted in the pivots of its LDLᵀ factors (complete pivoting).

    A pivot of two rows is taken where no single one is large enough; its determinant is negative, so one of its
    eigenvalues is.
    """
    a, negative = matrix.copy(), 0
    enough = (1 + math.sqrt(17)) / 8
    while len(a):
        diagonal = np.abs(np.diag(a))
        r = int(diagonal.argmax())
        off = np.abs(np.triu(a, 1))
        p, q = divmod(int(off.argmax()), len(a))
        if diagonal[r] >= enough * off[p, q]:
            pivot = a[r, r]
            if pivot == 0:
                return negative  # nothing but zeros is left
            negative += bool(pivot < 0)
            rest = np.delete(np.arange(len(a)), r)
            column = a[rest, r]
            a = a[np.ix_(rest, rest)] - np.outer(column, column / pivot)
        else:
            negative += 1
            rest = np.delete(np.arange(len(a)), [p, q])
            columns = a[np.ix_(rest, [p, q])]
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(a[np.ix_([p, q], [p, q])], columns.T)
        a = (a + a.T) / 2
    return negative


def _above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues above a shift."""
    return inertia(shift * np.eye(len(v)) - v)


def _isolate(v: np.ndarray, number: int, low: float, high: float, least: float) -> tuple[float, float]:
    """Bounds with eigenvalue ``number`` (from 1, by falling size) between them and, if they can be told apart, no other."""
    above_low, above_high = _above(v, low), _above(v, high)
    while high - low > least and (above_low > number or above_high < number - 1):
        middle = (low + high) / 2
        above = _above(v, middle)
        if above >= number:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    return low, high


def _solve(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray | None:
    """A unit vector along the solution; None if the shift is an eigenvalue to the last bit."""
    try:
        found = np.linalg.solve(matrix, vector)
    except np.linalg.LinAlgError:
        return None
    size = np.linalg.norm(found)
    return found / size if np.isfinite(size) and size > 0 else None


def leading(v: np.ndarray, most: int) -> list[tuple[float, np.ndarray]]:
    """(eigenvalue, unit eigenvector) of the leading eigenvalues that are above rounding, by falling size."""
    scale = float(np.abs(v).sum(axis=1).max(initial=0))
    if not scale:
        return []
    noise = scale * len(v) * np.finfo(float).eps
    identity = np.eye(len(v))
    found: list[tuple[float, np.ndarray]] = []
    rng = np.random.default_rng(3)
    for number in range(1, min(most, len(v)) + 1):
        low, high = _isolate(v, number, -noise, scale + noise, noise)
        if high <= noise:
            break
        before = np.array([f[1] for f in found]).reshape(-1, len(v))
        clear = lambda x: x - before.T @ (before @ x)  # noqa: B023, E731  equal eigenvalues have any basis
        vector = clear(rng.standard_normal(len(v)))
        vector /= np.linalg.norm(vector)
        value = (low + high) / 2
        for step in range(60):
            # Solves at the middle of the bounds until the quotient is between them; then the quotient is the shift.
            better = _solve(v - value * identity, vector)
            if better is None:
                value += noise * (step + 1) / 64
                continue
            vector = clear(better)
            vector /= np.linalg.norm(vector)
            quotient = float(vector @ v @ vector)
            residual = float(np.linalg.norm(v @ vector - quotient * vector))
            if residual <= 4 * noise and low - noise <= quotient <= high + noise:
                value = quotient
                break
            if low < quotient < high and step > 1:
                value = quotient
            else:
                if high - low > noise:
                    middle = (low + high) / 2
                    low, high = (middle, high) if _above(v, middle) >= number else (low, middle)
                value = (low + high) / 2
        if value <= 4 * noise:
            break
        margin = 8 * noise
        if not (_above(v, value + margin) < number <= _above(v, value - margin)):
            raise ArithmeticError(f"eigenvalue {number} is not certified by the counts")
        found.append((value, vector))
    return found


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def exact_products(x: np.ndarray) -> np.ndarray | list:
    """Sums of products of all pairs of columns of whole numbers, exact: in doubles, whose products stay whole."""
    width, largest = x.shape[1], int(np.abs(x).max(initial=0))
    rows = (EXACT - 1) // max(1, largest * largest)
    out = np.zeros((width, width), object)
    if rows < 1:
        big = x.astype(object)
        return big.T @ big
    for at in range(0, len(x), min(rows, 1 << 20)):
        part = x[at : at + min(rows, 1 << 20)].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def _products(near: np.ndarray) -> Callable[[Batches], Batches]:
    """(i, j, s): a task's sums of products, i <= j."""
    width = len(near)
    i, j = np.triu_indices(width)

    def run(batches: Batches) -> Batches:
        sums = np.zeros((width, width), object)
        for batch in batches:
            sums += exact_products(_numbers(batch.column("x"), width) - near)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(s)) for s in sums[i, j]], pa.decimal128(38, 0))], ["i", "j", "s"])

    return run


def _project(n: int, sums: list[int], basis: np.ndarray, values: np.ndarray) -> Callable[[Batches], Batches]:
    """(vec_id, deviation, whitened): exact squared deviation times n squared, and the scaled projections."""
    total = np.array(sums, object)
    mean = total // n
    near, over = mean.astype(np.int64), (total - mean * n).astype(np.int64)
    rest = over / n
    scaled = basis / np.sqrt(values)[:, None] if len(values) else basis

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = _numbers(batch.column("x"), len(sums))
            largest = (int(np.abs(x - near).max(initial=0)) + 1) * n
            if largest * largest * len(sums) < 1 << 63:
                apart = (x - near) * n - over
                deviation = (apart * apart).sum(axis=1).tolist()
            else:
                apart = x.astype(object) * n - total
                deviation = [d if d < 1 << 63 else None for d in (apart * apart).sum(axis=1)]
            white = ((x - near) - rest) @ scaled.T
            offsets = np.arange(len(batch) + 1, dtype=np.int32) * len(values)
            arrays = [batch.column("vec_id"), pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel()))]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "deviation", "whitened"])

    return run


def whiten(
    table: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = table.sparkSession
    batch_settings(spark)
    vector = F.col("v")
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    fine = (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(fine, F.lit(False)))
    x = F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c).cast("long") + F.lit(shift))
    rows = materialize(rows.select("vec_id", x.alias("x")), "whole_vectors")
    size = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()  # one row
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if size is None:
        return spark.createDataFrame([], schema)
    d = size["d"]
    rows = rows.where(F.size("x") == d)
    first = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("x", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(d)]).first()
    n, sums = first["n"], [int(first[f"s{i}"]) for i in range(d)]
    near = np.array([(s + n // 2) // n for s in sums], np.int64)
    products = rows.mapInArrow(_products(near), "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()  # d * (d + 1) / 2 rows
    rest = [s - n * int(m) for s, m in zip(sums, near)]  # sums of what is left after the whole number
    v = np.zeros((d, d))
    for r in products:
        # (n * products - rest * rest) / n², rounded once.
        v[r["i"], r["j"]] = v[r["j"], r["i"]] = (n * int(r["s"]) - rest[r["i"]] * rest[r["j"]]) / (n * n)
    found = leading(v, components)
    values, basis = np.array([f[0] for f in found]), np.array([f[1] for f in found]).reshape(-1, d)
    if not len(found):
        return spark.createDataFrame([], schema)
    white = materialize(rows.mapInArrow(_project(n, sums, basis, values), "vec_id long, deviation long, whitened array<double>"), "whitened")
    w = [F.get("whitened", F.lit(i)) for i in range(len(found))]
    off = [F.abs(F.covar_pop(w[i], w[j]) - F.lit(float(i == j))) for i in range(len(found)) for j in range(i, len(found))]
    error = white.agg(F.array_max(F.array(*off)).alias("identity_error"))
    trace = float(np.trace(v))
    part = F.array(*[F.lit(float(e) / trace) for e in values])
    each = white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    each = each.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(part, F.col("at")).alias("explained"))
    return each.withColumn("identity_error", F.lit(error.first()["identity_error"]))
