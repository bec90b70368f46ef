"""Whitening of embeddings by a bidiagonal qd solver (operator 13).

The centred rows are reduced block by block to one triangle R; R is made bidiagonal by Householder reflections, dqds finds
the singular values, and twisted factorisations give the directions. Rows stay in tasks; the driver sees triangles of
dimension x dimension only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from casewright.session import stage

_SCALE, _SHIFT = 64, 1_000_000
#: Scaled entries beyond this are set to it, so that they fit a whole number of 64 bits.
_MOST = 2.0**62
_EPS = float(np.finfo(float).eps)
#: Rows of one QR step, and partial results merged by one task.
_BLOCK = 4096
_FAN_IN = 32
#: Eigenvalues closer than this, relative to the larger, form a cluster.
_CLUSTER = 1e-3


# ---- singular values and directions of a small matrix -------------------------------------------

def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, right) with matrix = left @ bidiagonal @ right.T for some orthogonal left; matrix is square."""
    a = np.array(matrix, dtype=float)
    d = len(a)
    right = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        """v of I - 2 v v' that maps x to a multiple of the first unit vector; None where x is one already."""
        if not x[1:].any():
            return None
        x = x / np.abs(x).max()
        v = x.copy()
        v[0] += math.copysign(np.linalg.norm(x), x[0])
        return v / np.linalg.norm(v)

    for k in range(d - 1):
        if (v := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if (v := reflector(a[k, k + 1:])) is not None:
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
            right[:, k + 1:] -= 2 * np.outer(right[:, k + 1:] @ v, v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), right


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds step and the smallest of its d; None if the shift was too large."""
    new_q, new_e, d = [], [], q[0] - shift
    least = d
    for i in range(len(e)):
        if d < 0:
            return None
        pivot = d + e[i]
        if pivot == 0:
            return None if shift else (q, e, 0.0)
        ratio = q[i + 1] / pivot
        new_q.append(pivot)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    new_q.append(d)
    return None if d < 0 or not math.isfinite(d) else (new_q, new_e, least)


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling. Shifts are tried from large to small, so each step keeps
    every q positive and small values as accurate as large ones."""
    scale = max([abs(x) for x in [*diagonal, *above]], default=0.0) or 1.0
    found: list[float] = []
    todo = [([float(x / scale) ** 2 for x in diagonal], [float(x / scale) ** 2 for x in above], 0.0)] if len(diagonal) else []
    while todo:
        q, e, sigma = todo.pop()
        least = 0.0
        for _ in range(100 * len(q) + 200):
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] == 0 or e[i] <= 0.01 * _EPS * sigma), None)
            if cut is None and len(q) > 1 and e[-1] <= 0.01 * _EPS * (sigma + q[-1]):
                cut = len(e) - 1
            if cut is not None and cut < len(e) - 1:
                todo.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                least = 0.0
            elif cut is not None or len(q) == 1:
                found.append(sigma + q[-1])
                q, e = q[:-1], e[:-1]
                least = min(least, *q) if q else 0.0
            if not q:
                break
            if len(q) == 1:
                continue
            if q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            for part in (0.98, 0.75, 0.25, 0.0):
                if step := _transform(q, e, part * least):
                    sigma += part * least
                    q, e, least = step
                    break
            least = max(least, 0.0)
        else:
            raise RuntimeError("dqds did not settle")
    return np.array(sorted(found, reverse=True)) * scale * scale


def _factors(q: np.ndarray, low: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of L D L' - value: multipliers from the top and from the bottom, the twist's pivots, and the pivots from the top."""
    d = len(q)
    tiny = _EPS * _EPS * max(float(q.max()), 1e-300)
    down, up, gamma, pivots = np.zeros(d - 1), np.zeros(d - 1), np.zeros(d), np.zeros(d)
    s = np.zeros(d)
    s[0] = -value
    for i in range(d):
        pivot = s[i] + q[i]
        pivots[i] = pivot if abs(pivot) > tiny else math.copysign(tiny, pivot)
        if i < d - 1:
            down[i] = q[i] * low[i] / pivots[i]
            s[i + 1] = down[i] * low[i] * s[i] - value
    p = q[-1] - value
    gamma[-1] = s[-1] + q[-1]
    for i in range(d - 2, -1, -1):
        pivot = q[i] * low[i] ** 2 + p
        pivot = pivot if abs(pivot) > tiny else math.copysign(tiny, pivot)
        ratio = q[i] / pivot
        up[i] = low[i] * ratio
        p = p * ratio - value
        gamma[i] = s[i] + p + value
    return down, up, gamma, pivots


def _twisted(down: np.ndarray, up: np.ndarray, at: int) -> tuple[np.ndarray, float]:
    """The solution, at length one, of the twisted system with a one at row ``at`` on the right, and its length before."""
    d = len(down) + 1
    z = np.zeros(d)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(at, d - 1):
        z[i + 1] = -up[i] * z[i]
    length = float(np.linalg.norm(z))
    return z / length, length


def _inverse_step(down: np.ndarray, pivots: np.ndarray, x: np.ndarray) -> np.ndarray:
    y = x.copy()
    for i in range(len(down)):
        y[i + 1] -= down[i] * y[i]
    y = y / pivots
    for i in range(len(down) - 1, -1, -1):
        y[i] -= down[i] * y[i + 1]
    return y / np.linalg.norm(y)


def _apart(z: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, float]:
    """``z`` without its part along ``near``, at length one, and the length of what was left."""
    rest = z - near @ (near.T @ z)
    left = float(np.linalg.norm(rest))
    if left == 0:
        return z, 0.0
    rest = rest / left
    rest -= near @ (near.T @ rest)
    return rest / np.linalg.norm(rest), left


def directions(diagonal: np.ndarray, above: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Columns: unit right singular vectors of the bidiagonal matrix for the given squares of its singular values (falling).

    Each comes from the twisted factorisation of L D L' - value, with the twist at the smallest pivot. Members of a cluster are
    made orthogonal to those before; where that leaves little of a vector, the next smallest pivots are tried (they belong to other
    blocks of the matrix), and then inverse iteration beside the value.
    """
    d = len(diagonal)
    scale = max([1e-300, *np.abs(diagonal), *np.abs(above)])
    a = np.where(np.abs(diagonal) > _EPS * scale * 1e-4, diagonal, _EPS * scale * 1e-4)
    b = np.where(np.abs(above) > _EPS * scale / 2, above, 0.0)
    q, low, values = (a / scale) ** 2, b / a[:-1], squares / scale**2
    rng = np.random.default_rng(7)
    out, cluster = np.zeros((d, len(values))), 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > _CLUSTER * values[k - 1]:
            cluster = k
        near = out[:, cluster:k]
        down, up, gamma, _ = _factors(q, low, float(value))
        for at in np.argsort(np.abs(gamma), kind="stable")[:k - cluster + 1]:
            z, length = _twisted(down, up, int(at))
            z, left = _apart(z, near)
            if left > 0.5 and (abs(gamma[at]) <= 64 * d * _EPS * length or k == cluster):
                break
        else:
            for attempt in range(40):
                beside = float(value) * (1 + (attempt % 8 - 3.5) * 8 * _EPS)
                down, _, _, pivots = _factors(q, low, beside)
                if attempt % 8 == 0:
                    z = _apart(rng.standard_normal(d), near)[0]
                z, left = _apart(_inverse_step(down, pivots, z), near)
                if left > 0.5 and attempt % 8 > 1:
                    break
            else:
                raise RuntimeError("a direction of a cluster was not found")
        out[:, k] = z
    return out


def principal(triangle: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(squares of singular values, directions as columns, sum of all squares); values that are zero to rounding are left out."""
    diagonal, above, right = bidiagonalise(triangle)
    squares = dqds(diagonal, above)
    floor = (16 * len(triangle) * _EPS) ** 2 * squares[0]
    some = squares[:most][squares[:most] > floor]
    vectors = right @ directions(diagonal, above, some) if len(some) else np.zeros((len(triangle), 0))
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(some))]) if len(some) else 1
    return some, vectors * signs, math.fsum(squares)


# ---- rows ---------------------------------------------------------------------------------------

def usable(vector: Column) -> Column:
    """The vector is not null or empty and holds no null, NaN or infinite entry."""
    return F.coalesce(F.size(vector) > 0, F.lit(False)) & F.coalesce(F.forall(vector, lambda c: F.coalesce(
        F.abs(c.cast("double")) < F.lit(math.inf), F.lit(False))), F.lit(False))


def on_grid(vector: Column) -> Column:
    """floor(64 c) + 1,000,000 for every entry."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * _SCALE, F.lit(_MOST)), F.lit(-_MOST))) + F.lit(_SHIFT).cast("long"))


def _blocks(column: pa.ListArray, d: int) -> Iterator[np.ndarray]:
    """Rows of a list column without the shift, some thousand at a time."""
    cells = np.asarray(column.flatten()).reshape(-1, d) - _SHIFT
    for at in range(0, len(cells), _BLOCK):
        yield cells[at:at + _BLOCK]


def _merged(parts: DataFrame, combine: Callable[[np.ndarray, np.ndarray], np.ndarray], name: str) -> np.ndarray:
    """The partial arrays (part, values) of all tasks, merged 32 at a time in the order of the tasks until one is left."""
    schema = "part long, values array<double>"

    def step(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        total = None
        for values in rows["values"]:
            values = np.asarray(values, dtype=float)
            total = values if total is None else combine(total, values)
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "values": [total]})

    parts = stage(parts, name)
    lanes = parts.agg(F.max("part")).first()[0] + 1
    while lanes > 1:
        parts = parts.withColumn("part", F.floor(F.col("part") / _FAN_IN)).groupBy("part").applyInPandas(step, schema)
        lanes = -(-lanes // _FAN_IN)
    return np.asarray(parts.first()["values"], dtype=float)


def _partial(make: Callable[[Iterator[np.ndarray]], np.ndarray | None], d: int):
    """For mapInArrow: one (part, values) row from all rows of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = make(block for batch in batches for block in _blocks(batch.column("x"), d))
        if made is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([made.ravel()], pa.list_(pa.float64()))],
                                             names=["part", "values"])

    return run


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int], int]:
    """(rows, exact sum of each dimension, largest absolute entry), all without the shift."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, most, n = [0] * d, 0, 0
        for batch in batches:
            for block in _blocks(batch.column("x"), d):
                high = int(np.abs(block).max())
                most, n = max(most, high), n + len(block)
                sums = block.sum(axis=0) if high < 1 << 50 else block.astype(object).sum(axis=0)
                total = [a + int(b) for a, b in zip(total, sums)]
        if n:
            yield pa.RecordBatch.from_pydict({"dim": list(range(d)), "total": [str(t) for t in total], "most": [most] * d, "n": [n] * d})

    rows = (fit.mapInArrow(run, "dim long, total string, most long, n long").groupBy("dim")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.max("most").alias("most"), F.sum("n").alias("n")).orderBy("dim").collect())
    return rows[0]["n"], [int(r["total"]) for r in rows], max(r["most"] for r in rows)


def _centre(block: np.ndarray, n: int, sums: list[int], exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """(n x - S modulo 2**64, (n x - S) / n as doubles); the first is the number itself if ``exact`` says that it fits."""
    with np.errstate(over="ignore"):
        whole = block * np.int64(n) - np.array([s & (2**64 - 1) for s in sums], dtype=np.uint64).view(np.int64)
    if exact:
        return whole, whole / n
    return whole, np.array([[(n * int(v) - s) / n for v, s in zip(row, sums)] for row in block], dtype=float).reshape(block.shape)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16) -> DataFrame:
    """Whitened coordinates: id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained, identity_error.

    Entries are put on a grid, x = floor(64 c) + 1,000,000. Mean and covariance (divisor n) are over the distinct x vectors; every
    row with a usable vector is returned, once per component, repeated rows and null ids too. Rows whose vector is null, empty or
    holds a null, NaN or infinite entry are left out. Directions are unit eigenvectors, their largest entry positive.

    There are at most as many components as the covariance has rank (to rounding), so a table of equal vectors, like an empty
    table, gives no rows. Equal eigenvalues get some orthonormal directions of their space. Scaled entries beyond 2**62 count as
    that; a deviation of 2**63 or more is null. Vectors of different lengths raise a ``ValueError``. Other columns are ignored.
    """
    spark = vectors.sparkSession
    good = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).filter(usable(F.col("v"))).select("id", on_grid(F.col("v")).alias("x"))
    id_type = good.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = stage(good.select("x").distinct(), "whitening-fit")
    lengths = fit.agg(F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    if lengths["low"] is None:
        return spark.createDataFrame([], schema)
    if lengths["low"] != lengths["high"]:
        raise ValueError(f"vectors have from {lengths['low']} to {lengths['high']} entries")
    d = lengths["low"]
    n, sums, most = _sums(fit, d)
    exact = 2 * n * (most + 1) < 1 << 62

    def triangle(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        r = None
        for block in blocks:
            rows = _centre(block, n, sums, exact)[1]
            r = np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")
        return None if r is None else np.vstack([r, np.zeros((d - len(r), d))])

    def stacked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.linalg.qr(np.vstack([a.reshape(d, d), b.reshape(d, d)]), mode="r").ravel()

    parts = "part long, values array<double>"
    squares, found, trace = principal(_merged(fit.mapInArrow(_partial(triangle, d), parts), stacked, "whitening-triangles").reshape(d, d), components)
    k = len(squares)
    if not k:
        return spark.createDataFrame([], schema)
    to_white = found / np.sqrt(squares / n)

    def moments(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        total = None
        for block in blocks:
            w = _centre(block, n, sums, exact)[1] @ to_white
            part = np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
            total = part if total is None else total + part
        return total

    both = _merged(fit.mapInArrow(_partial(moments, d), parts), np.add, "whitening-moments") / n
    error = float(np.abs(both[k:].reshape(k, k) - np.outer(both[:k], both[:k]) - np.eye(k)).max())
    explained = (squares / trace).tolist()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch.column("id"), 0
            for block in _blocks(batch.column("x"), d):
                whole, centred = _centre(block, n, sums, exact)
                with np.errstate(over="ignore"):
                    deviation = (whole * whole).sum(axis=1)
                about = (centred * n * (centred * n)).sum(axis=1)
                fits = about < 2.0**63
                for i in np.flatnonzero(np.abs(about / 2.0**63 - 1) < 1e-9):  # too close for doubles to tell
                    fits[i] = sum((n * int(v) - s) ** 2 for v, s in zip(block[i], sums)) < 1 << 63
                m = len(block)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(np.repeat(np.arange(at, at + m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, dtype=np.int64)), pa.array(np.repeat(deviation, k), mask=np.repeat(~fits, k)),
                    pa.array((centred @ to_white).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
                at += m

    return good.mapInArrow(rows, schema)
