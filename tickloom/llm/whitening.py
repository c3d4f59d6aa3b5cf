"""Embedding whitening: leading components of the covariance by spectrum slicing.

The number of eigenvalues of a symmetric matrix A above a value s is the number of positive pivots
of an LDL^T factorisation of A - sI (Sylvester's law of inertia). Bisection with these counts
isolates each leading eigenvalue in an interval of its own; Rayleigh quotient iteration then
converges cubically to it and its vector, and two more counts just below and above certify which
eigenvalue it is. Eigenvalues that rounding cannot tell apart are a group, for which any orthonormal
basis of its space will do.

The covariance is that of the distinct integer vectors. Partitions send sums of integers, so nothing
depends on the order in which they are added; a matrix of dimensions times dimensions is all that
reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import col, stage

EPS = np.finfo(float).eps
_ROWS = 2048  # vectors worked on at once
_ALPHA = (1 + 17**0.5) / 8  # bounds the growth of elements in a factorisation


# Spectrum slicing


def inertia(a: np.ndarray) -> tuple[int, int]:
    """The numbers of positive and of negative eigenvalues of a symmetric matrix.

    LDL^T with symmetric pivoting after Bunch and Kaufman: D has blocks of one or two rows, and a
    block of two has one eigenvalue of either sign. Pivots of rounding size count as neither.
    """
    a = a.astype(float)
    least = EPS * max(1e-300, np.abs(a).max(initial=0))

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    up = down = 0
    while len(a):
        below = np.abs(a[1:, 0])
        column = below.max(initial=0)
        width = 1
        if max(abs(a[0, 0]), column) <= least:
            a = a[1:, 1:]
            continue
        if abs(a[0, 0]) < _ALPHA * column:
            r = 1 + int(below.argmax())
            row = np.abs(a[r])
            row[r] = 0
            if abs(a[0, 0]) * row.max() < _ALPHA * column**2:
                if abs(a[r, r]) >= _ALPHA * row.max():
                    swap(0, r)
                else:
                    swap(1, r)
                    width = 2
        if width == 1:
            up, down = up + (a[0, 0] > 0), down + (a[0, 0] < 0)
            a = a[1:, 1:] - np.outer(a[1:, 0] / a[0, 0], a[0, 1:])
        else:
            up, down = up + 1, down + 1
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(a[:2, :2], a[:2, 2:])
    return int(up), int(down)


def above(a: np.ndarray, value: float) -> int:
    """How many eigenvalues are greater than a value."""
    return inertia(a - value * np.eye(len(a)))[0]


def _refine(
    a: np.ndarray, low: float, high: float, found: list[np.ndarray], seed: int
) -> tuple[float, np.ndarray] | None:
    """Rayleigh quotient iteration for the one eigenvalue between two bounds, None if it leaves them.

    ``found`` are the vectors of greater eigenvalues, which the iteration stays orthogonal to.
    """
    one, size = np.eye(len(a)), np.abs(a).max()

    def clean(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for u in found:
                v = v - (u @ v) * u
        return v / np.linalg.norm(v)

    def solve(shift: float, v: np.ndarray) -> np.ndarray:
        try:
            w = np.linalg.solve(a - shift * one, v)
        except np.linalg.LinAlgError:
            w = np.linalg.solve(a - (shift + 4 * EPS * size) * one, v)
        return clean(w) if np.isfinite(w).all() else v

    v = clean(np.random.default_rng(seed).standard_normal(len(a)))
    for _ in range(3):  # towards the eigenvalue of the interval, whichever is nearest to its middle
        v = solve((low + high) / 2, v)
    best, best_left = None, np.inf
    for _ in range(20):
        rho = float(v @ a @ v)
        left = float(np.linalg.norm(a @ v - rho * v))
        if left < best_left:
            best, best_left = (rho, v), left
        elif best_left <= 1e-12 * size:
            break
        if left <= EPS * size:
            break
        v = solve(rho, v)
    if best is None or not low <= best[0] <= high or best_left > 1e-10 * size:
        return None
    return best


def _group(a: np.ndarray, value: float, many: int, found: list[np.ndarray]) -> list:
    """An orthonormal basis of the space of ``many`` eigenvalues that equal a value to rounding."""
    size = np.abs(a).max()
    shifted = a - (value + 64 * EPS * size) * np.eye(len(a))
    basis = np.random.default_rng(many).standard_normal((len(a), many))
    for _ in range(6):
        basis = np.linalg.solve(shifted, basis)
        for _ in range(2):
            for u in found:
                basis = basis - np.outer(u, u @ basis)
        basis = np.linalg.qr(basis)[0]
    pairs = [(float(v @ a @ v), v) for v in basis.T]
    return sorted(pairs, key=lambda pair: -pair[0])


def leading(a: np.ndarray, most: int) -> list[tuple[float, np.ndarray]]:
    """The greatest eigenvalues of a positive semidefinite matrix with unit vectors, falling.

    At most ``most`` pairs, and none whose eigenvalue is zero to rounding.
    """
    scale = float(np.abs(a).max(initial=0))
    if not scale:
        return []
    a = a / scale
    top = float(np.abs(a).sum(axis=1).max()) * (1 + 1e-9)  # no eigenvalue lies beyond
    near = 64 * EPS * len(a) * top
    most = min(most, above(a, near))
    result: list[tuple[float, np.ndarray]] = []
    while len(result) < most:
        k = len(result)
        found = [v for _, v in result]
        low, high = 0.0, top
        in_low, in_high = len(a), 0
        while True:
            pair = None
            if in_low == k + 1 and in_high == k and high - low < 0.1 * high:
                pair = _refine(a, low, high, found, k)
            if pair is not None:
                rho = pair[0]
                if above(a, rho + near) <= k < above(a, rho - near):  # the (k + 1)th it is
                    result.append(pair)
                    break
            middle = (low + high) / 2
            if high - low <= near or not low < middle < high:
                result += _group(a, middle, max(1, in_low - k), found)
                break
            count = above(a, middle)
            if count > k:
                low, in_low = middle, count
            else:
                high, in_high = middle, count
    return [(e * scale, v) for e, v in result[:most]]


# Over the rows of a table


class Whitener(NamedTuple):
    """How vectors of one length are whitened.

    ``n`` distinct vectors with the sums ``sums``; ``vectors`` holds a unit eigenvector per row,
    ``values`` their eigenvalues, ``trace`` the sum of all.
    """

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    error: float = 0.0

    def away(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exactly; as Python integers if 64 bits might not hold it."""
        reach = self.n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, self.sums), default=0)
        if reach < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def whitened(self, away: np.ndarray) -> np.ndarray:
        """x - S/n on every component, over the root of its eigenvalue."""
        return (away / self.n).astype(float) @ self.vectors.T / np.sqrt(self.values)


def deviations(away: np.ndarray) -> list[int | None]:
    """Sums of squares over each row, exactly; None where a BIGINT cannot hold it."""
    reach = int(np.abs(away).max(initial=0))
    if away.dtype != object and reach * reach * max(1, away.shape[1]) < 1 << 63:
        return (away * away).sum(axis=1).tolist()
    totals = [sum(int(v) * int(v) for v in row) for row in away]
    return [t if t < 1 << 63 else None for t in totals]


def _by_length(vectors: pa.Array) -> Iterator[tuple]:
    """Integer vectors as matrices, a length at a time, with the places of their rows."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    length = np.diff(vectors.offsets.to_numpy())
    start = np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64)
    for size in np.unique(length).tolist():
        rows = np.flatnonzero(length == size)
        for i in range(0, len(rows), _ROWS):
            own = rows[i : i + _ROWS]
            yield size, own, flat[start[own][:, None] + np.arange(size)[None, :]]


def integer_rows(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> DataFrame:
    """``vec_id`` and ``x``, floor(scale * c) of every entry, of the rows that take part.

    Left out are rows whose vector is null or holds a null or non-finite entry. Entries beyond a
    BIGINT become its bounds.
    """
    vector = F.transform(col(vector_col), lambda c: c.cast("double"))
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c))
    chosen = rows.where(col(vector_col).isNotNull()).where(sound)
    return chosen.select(col(id_col).cast("bigint").alias("vec_id"), x.alias("x"))


def _sums(fit: DataFrame, part, kind: str = "double") -> dict[int, list]:
    """What ``part`` gives for the matrices of each length, added up over all partitions.

    Each partition sends one row per number, whose count depends on the dimensions alone; Spark adds
    them up by their place.
    """
    exact = kind != "double"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, x in _by_length(batch.column("x")):
                got = part(size, x)
                totals[size] = totals[size] + got if size in totals else got
        for size, total in totals.items():
            flat = [Decimal(int(v)) for v in total] if exact else total.ravel().tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([size] * len(flat), pa.int64()),
                    pa.array(range(len(flat)), pa.int64()),
                    pa.array(flat, pa.decimal128(38, 0) if exact else pa.float64()),
                ],
                names=["size", "at", "value"],
            )

    parts = fit.mapInArrow(task, f"size bigint, at bigint, value {kind}")
    found = parts.groupBy("size", "at").agg(F.sum("value").alias("value")).toArrow()
    result: dict[int, list] = {}
    order = [("size", "ascending"), ("at", "ascending")]
    for row in found.sort_by(order).to_pylist():
        result.setdefault(row["size"], []).append(int(row["value"]) if exact else row["value"])
    return result


def fit_whiteners(fit: DataFrame, most: int) -> dict[int, Whitener]:
    """A whitener for each length of the distinct integer vectors ``x`` of a staged table.

    Three passes: sums; products of the entries less their rounded means, whose small remainders
    are taken off exactly; and the covariance of the whitened vectors, for ``error``.
    """
    def count_and_sums(size: int, x: np.ndarray) -> np.ndarray:
        small = int(np.abs(x).max(initial=0)) < 1 << 50
        total = x.sum(axis=0) if small else x.astype(object).sum(axis=0)
        return np.array([len(x), *total.tolist()], object)

    sums = {n: (v[0], v[1:]) for n, v in _sums(fit, count_and_sums, "decimal(38,0)").items()}
    middle = {
        size: np.array([round(Fraction(s, n)) for s in totals], object)
        for size, (n, totals) in sums.items()
    }

    def products(size: int, x: np.ndarray) -> np.ndarray:
        centre = middle[size]
        wide = int(np.abs(x).max(initial=0)) + int(np.abs(centre).max(initial=0))
        y = (x - centre.astype(np.int64)) if wide < 1 << 62 else (x.astype(object) - centre)
        y = y.astype(float)  # exact, as are sums of products below 2^53
        return y.T @ y

    result = {}
    for size, flat in _sums(fit, products).items():
        n, totals = sums[size]
        rest = np.array([float(Fraction(s, n) - int(m)) for s, m in zip(totals, middle[size])])
        v = np.array(flat).reshape(size, size) / n - np.outer(rest, rest)
        pairs = leading((v + v.T) / 2, most)
        values = np.array([e for e, _ in pairs])
        vectors = np.array([u for _, u in pairs]).reshape(len(pairs), size)
        result[size] = Whitener(n, totals, values, vectors, float(np.trace(v)))

    def moments(size: int, x: np.ndarray) -> np.ndarray:
        w = result[size].whitened(result[size].away(x))
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    for size, flat in _sums(fit, moments).items():
        own = result[size]
        k = len(own.values)
        mean = np.array(flat[:k]) / own.n
        covariance = np.array(flat[k:]).reshape(k, k) / own.n - np.outer(mean, mean)
        result[size] = own._replace(error=float(np.abs(covariance - np.eye(k)).max(initial=0)))
    return result


def whiten(
    rows: DataFrame,
    most: int = 4,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """Every sound vector on each leading component, whitened.

    Columns: ``vec_id``, ``component`` from 1 on, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``. The fit list is each distinct integer vector once, so copies change nothing.
    Vectors of different lengths have nothing in common: those of each length are fitted and
    whitened among themselves. Components whose variance is zero to rounding cannot be whitened and
    are left out, so a table of equal vectors, or of empty ones, gives no rows. Rows whose vector is
    null or holds null or non-finite entries are dropped; a null id stays null and rows that repeat
    an id all stay. ``deviation`` is null where a BIGINT cannot hold it. Other columns, of any name,
    are not looked at; an empty table gives no rows.
    """
    vectors = integer_rows(rows, id_col, vector_col, scale)
    fit = stage(vectors.where(F.size("x") > 0).select("x").distinct(), "distinct-vectors")
    models = fit_whiteners(fit, most)
    shared = rows.sparkSession.sparkContext.broadcast(models)  # most * dimensions numbers a length

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for size, own, x in _by_length(batch.column("x")):
                model = shared.value.get(size)
                if model is None or not len(model.values):
                    continue
                k, away = len(model.values), model.away(x)
                each = np.repeat(own, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(own))),
                        pa.array([model.n] * len(each), pa.int64()),
                        pa.array(deviations(away), pa.int64()).take(
                            pa.array(np.repeat(np.arange(len(own)), k))
                        ),
                        pa.array(model.whitened(away).ravel()),
                        pa.array(np.tile(model.values / model.trace, len(own))),
                        pa.array([model.error] * len(each), pa.float64()),
                    ],
                    names=NAMES,
                )

    return vectors.mapInArrow(task, SCHEMA)


SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation bigint, "
    "whitened double, explained double, identity_error double"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]

