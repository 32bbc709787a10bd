"""Operator 13, embedding whitening by FEAST contour integration.

The covariance V of the distinct quantised vectors is summed by Spark; only
its d x d entries reach the driver, however many rows there are.  Inertia
counts (signs of the pivots of V - s I) tell how many eigenvalues lie above
a shift s and slice the upper end of the spectrum into intervals of few
eigenvalues each.  The intervals are independent of one another and are
solved in Spark tasks: quadrature of complex shifted solves (z I - V)^-1 Q
along a circle around the interval projects a block Q onto the interval's
eigenvectors, Rayleigh-Ritz extracts them, and the interval is done when as
many as the inertia counts say have converged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.common import written

#: Quantised entries beyond this are not told apart by doubles.
RANGE = 2 ** 52


# --------------------------------------------------------------- eigenvectors
def inertia(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``v`` lie above ``shift``: the
    positive ones of the block pivots of an L D L' factorisation of
    ``v - shift I`` (Sylvester), with complete pivoting over 1x1 and 2x2
    blocks, which is stable for every shift."""
    a = v - shift * np.eye(len(v))
    above, grow = 0, (1 + 17 ** 0.5) / 8
    while n := len(a):
        diagonal = np.abs(a.diagonal())
        p = int(diagonal.argmax())
        off = np.abs(np.tril(a, -1))
        r, q = np.unravel_index(int(off.argmax()), off.shape)
        if diagonal[p] == 0 and off[r, q] == 0:
            return above  # the rest is zero: at the shift, not above it
        if diagonal[p] >= grow * off[r, q]:
            use, above = [p], above + int(a[p, p] > 0)
        else:
            use, above = [q, r], above + 1  # one positive, one negative
        rest = np.setdiff1d(np.arange(n), use)
        a = a[np.ix_(rest, rest)] - a[np.ix_(rest, use)] @ np.linalg.solve(a[np.ix_(use, use)], a[np.ix_(use, rest)])
        a = (a + a.T) / 2
    return above


def slices(v: np.ndarray, k: int, most: int = 8) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside), by falling position, that
    together hold at least the ``k`` largest eigenvalues of ``v`` (all that
    are not numerically zero, if fewer).  An interval holds at most ``most``,
    or eigenvalues too near each other to part."""
    trace, d = float(np.trace(v)), len(v)
    top = trace * (1 + 1e-9)
    floor = trace * d * np.finfo(float).eps  # beneath it lie zeros and noise
    k = min(k, inertia(v, floor))
    if not k:
        return []
    low, high, held = floor, top, inertia(v, floor)
    while held > k + most // 2 and high - low > 1e-12 * trace:  # raise the lower edge
        mid = (low + high) / 2
        if (n := inertia(v, mid)) >= k:
            low, held = mid, n
        else:
            high = mid
    done, todo = [], [(low, top, held)]
    while todo:
        lo, hi, n = todo.pop()
        wide = hi > 4 * lo  # seen from its middle, what lies beneath would crowd at the edge
        if not n or (n <= most and not wide) or hi - lo <= 1e-12 * trace:
            if n:
                done.append((float(lo), float(hi), n))
            continue
        for nudge in (0.5, 0.53, 0.47, 0.57, 0.43):  # an edge with no eigenvalue right at it
            mid = lo * (hi / lo) ** nudge if wide else lo + (hi - lo) * nudge
            if inertia(v, mid * (1 - 1e-7)) == inertia(v, mid * (1 + 1e-7)):
                break
        above = inertia(v, mid) - inertia(v, hi)
        todo += [(lo, mid, n - above), (mid, hi, above)]
    return sorted(done, reverse=True)


def feast(v: np.ndarray, low: float, high: float, held: int, nodes: int = 8, rounds: int = 60,
          tolerance: float = 1e-13) -> tuple[np.ndarray, np.ndarray]:
    """The ``held`` eigenvalues of ``v`` in (low, high] and their unit
    eigenvectors (columns), by falling eigenvalue.

    A block of some more columns than ``held`` is projected by the trapezoid
    rule on the circle around the interval; conjugate nodes give conjugate
    values, so half of them are solved.  Every eight rounds the nodes double.  Raises if the count does not settle.
    """
    d, scale = len(v), float(np.abs(v).sum(axis=1).max()) or 1.0
    size = min(d, held + max(4, held // 2))
    block = np.random.default_rng(13).standard_normal((d, size))
    middle, radius, eye = (low + high) / 2, max((high - low) / 2, 1e-13 * scale), np.eye(d)
    turn = np.exp(1j * np.pi * (np.arange(nodes) + 0.5) / nodes)
    settled = False
    for done in range(rounds):
        if done and done % 8 == 0 and nodes < 64:  # a steeper filter parts near neighbours
            nodes *= 2
            turn = np.exp(1j * np.pi * (np.arange(nodes) + 0.5) / nodes)
        image = np.zeros((d, size))
        for t in turn:
            image += (radius * t * np.linalg.solve((middle + radius * t) * eye - v, block)).real / nodes
        basis, _ = np.linalg.qr(image)
        value, vector = np.linalg.eigh(basis.T @ v @ basis)
        block = basis @ vector
        inside = np.flatnonzero((value > low) & (value <= high))
        left = np.abs(v @ block[:, inside] - block[:, inside] * value[inside]).max(initial=0.0)
        before, settled = settled, inside.size == held and left <= tolerance * scale
        if settled and before:  # one round more than needed
            order = inside[::-1]
            return value[order], block[:, order]
    raise RuntimeError(f"{inside.size} of {held} eigenvalues settled between {low} and {high}")


def _solve_slices(v: np.ndarray):
    """Rows (low, high, held) to (value, vector) of their eigenpairs."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo, hi, n in zip(b["low"], b["high"], b["held"]):
                value, vector = feast(v, lo, hi, n)
                yield pd.DataFrame({"value": value, "vector": list(vector.T)})
    return run


def components(spark, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of ``v`` and their eigenvectors (rows);
    fewer, if the rest is numerically zero.  One task per slice; ``k`` rows
    of d numbers come back."""
    parts = slices(v, k)
    if not parts:
        return np.zeros(0), np.zeros((0, len(v)))
    table = spark.createDataFrame(parts, "low double, high double, held int").repartition(len(parts))
    rows = table.mapInPandas(_solve_slices(v), "value double, vector array<double>").collect()
    # vectors of different slices are orthogonal up to their residuals: a last joint Rayleigh-Ritz step
    basis, _ = np.linalg.qr(np.array([r["vector"] for r in rows]).T)
    value, turn = np.linalg.eigh(basis.T @ v @ basis)
    top = np.argsort(-value, kind="stable")[:k]
    return value[top], (basis @ turn[:, top]).T


# ------------------------------------------------------------------ on Spark
def _products(center: np.ndarray, matrix: np.ndarray | None = None):
    """Batches of ``_x`` to one row per task: sums of the centred vectors
    (projected by ``matrix``) and of their products, upper half by rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        d = len(center) if matrix is None else len(matrix)
        total, product, seen = np.zeros(d), np.zeros((d, d)), False
        for b in batches:
            if len(b):
                c = np.stack(b["_x"].to_numpy()).astype(np.int64) - center
                c = c if matrix is None else c @ matrix.T
                total, product, seen = total + c.sum(axis=0), product + c.T @ c, True
        if seen:
            yield pd.DataFrame({"_s": [np.concatenate([total, product[np.triu_indices(d)]])]})
    return run


def covariance(fit: DataFrame, n: int, center: np.ndarray, matrix: np.ndarray | None = None) -> np.ndarray:
    """Covariance (divisor ``n``) of the centred vectors ``_x`` of ``fit``,
    projected by ``matrix`` if given.  Each task sums its own rows; Spark adds
    the tasks' sums entry by entry, so d(d+3)/2 numbers reach the driver."""
    d = len(center) if matrix is None else len(matrix)
    sums = fit.mapInPandas(_products(center, matrix), "_s array<double>").select(
        F.posexplode("_s").alias("_i", "_v")).groupBy("_i").agg(F.sum("_v").alias("_v")).collect()
    flat = np.zeros(d + d * (d + 1) // 2)
    for r in sums:
        flat[r["_i"]] = r["_v"]
    mean, out = flat[:d] / n, np.zeros((d, d))
    out[np.triu_indices(d)] = flat[d:] / n
    out = out + np.triu(out, 1).T
    return out - np.outer(mean, mean)  # the mean of centred vectors is rounding only


def quantised(rows: DataFrame, id_col: str, vector: str, scale: float, offset: int) -> DataFrame:
    """``vec_id`` and ``_x`` (array<long>) of the usable rows, see :func:`whiten`."""
    v = F.col(vector).cast("array<double>")
    d = rows.select(F.col(id_col).alias("vec_id"), v.alias("_v")).where(F.size("_v") > 0)
    good = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < RANGE)
    d = d.where(F.forall("_v", lambda c: F.coalesce(good(c), F.lit(False))))
    return d.select("vec_id", F.transform("_v", lambda c: F.floor(c * F.lit(scale)) + F.lit(offset)).alias("_x"))


def _project(n: int, sums: np.ndarray, matrix: np.ndarray, explained: np.ndarray, error: float, id_type: str):
    """Rows (vec_id, _x) to a row per component."""
    k, center = len(matrix), sums / n
    exact = np.array([int(s) for s in sums], dtype=object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            x = np.stack(b["_x"].to_numpy()).astype(np.int64)
            c = x - center
            far = np.abs(c).max() * n  # as doubles: is there room in 64 bits?
            if far * far * x.shape[1] < 2.0 ** 62 and np.abs(x).max() * float(n) < 2.0 ** 62:
                deviation = list(((n * x - sums.astype(np.int64)) ** 2).sum(axis=1))
            else:  # whole numbers of any size; null where a long can't hold them
                deviation = [int(((n * r.astype(object) - exact) ** 2).sum()) for r in x]
                deviation = [a if a < 2 ** 63 else None for a in deviation]
            yield pd.DataFrame({
                "vec_id": b["vec_id"].repeat(k), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(b)),
                "n": n, "deviation": pd.array(deviation, dtype="Int64").repeat(k),
                "whitened": (c @ matrix.T).ravel(), "explained": np.tile(explained, len(b)), "identity_error": error})
    return run


def whiten(rows: DataFrame, k: int = 16, id_col: str = "vec_id", vector: str = "embedding",
           scale: float = 64.0, offset: int = 1_000_000) -> DataFrame:
    """Whitened components of every usable vector, fitted on the distinct
    quantised vectors x = floor(scale * c) + offset.

    One row per usable row and component up to ``k``: ``vec_id``,
    ``component`` (from 1, by falling eigenvalue), ``n`` (distinct vectors),
    ``deviation`` (squared distance of n*x from the sum S of all distinct
    vectors, exact), ``whitened`` (x - S/n on the component, over the root of
    its eigenvalue), ``explained`` (its share of the trace) and
    ``identity_error`` (largest absolute entry of the whitened fit list's
    covariance minus the identity, measured over the fit list).

    Vectors that are null or empty, hold null or non-finite entries, or
    entries beyond 2^52 / ``scale``, drop out; so do vectors of another length
    than the commonest (on ties the longest).  Components with a numerically
    zero eigenvalue are left out, so fewer than ``k`` may come back, and none
    if all vectors are equal or none is usable.  Eigenvectors of equal
    eigenvalues are any orthonormal ones.  ``deviation`` is null where a long
    can't hold it.  Null ids and repeated rows give rows of their own; other
    columns, also very long texts, are not read.

    The fit list is grouped with partial sums, so a vector that a third of
    all rows share costs one row per task.  Sums (d numbers) and covariance
    entries (d squared) reach the driver, vectors never do.
    """
    spark = rows.sparkSession
    usable = quantised(rows, id_col, vector, scale, offset)
    fit = written(usable.groupBy("_x").agg(F.count(F.lit(1)).alias("_copies")), "fit-list")
    id_type = dict(usable.dtypes)["vec_id"]
    schema = (f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    lengths = fit.groupBy(F.size("_x").alias("d")).agg(F.sum("_copies").alias("rows"), F.count(F.lit(1)).alias("n"))
    best = lengths.orderBy(F.col("rows").desc(), F.col("d").desc()).first()
    if best is None:
        return spark.createDataFrame([], schema)
    d, n = best["d"], best["n"]
    fit = fit.where(F.size("_x") == d).select("_x")
    totals = fit.select(F.posexplode("_x").alias("_i", "_v")).groupBy("_i").agg(
        F.sum(F.col("_v").cast("decimal(38,0)")).alias("_v")).collect()  # d numbers
    sums = np.zeros(d, dtype=object)
    for r in totals:
        sums[r["_i"]] = int(r["_v"])
    center = np.array([s / n for s in sums], dtype=np.float64)
    v = covariance(fit, n, center)
    value, vectors = components(spark, v, k)
    if not len(value):
        return spark.createDataFrame([], schema)
    matrix = vectors / np.sqrt(value)[:, None]
    error = float(np.abs(covariance(fit, n, center, matrix) - np.eye(len(value))).max())
    return usable.where(F.size("_x") == d).mapInPandas(
        _project(n, sums, matrix, value / np.trace(v), error, id_type), schema)
