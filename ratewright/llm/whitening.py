"""Whitening of embeddings through singular values of a bidiagonal matrix.

1. Every task reduces its centred rows block by block to one triangular factor (QR of the factor so far on top of the
   next block); factors are reduced in turn, a bounded number at a time, until one is left. Its size depends on the
   dimensions alone, and so does all that follows on the driver.
2. Householder reflections from both sides make it upper bidiagonal.
3. The differential quotient-difference algorithm with shifts (dqds) finds the squared singular values to high
   relative accuracy: only products, quotients and sums of positive numbers, and shifts below the smallest value.
4. A twisted factorisation of the tridiagonal B^T B less a squared singular value gives the vector in one sweep up and
   one down from the row where the twist leaves least; the reflections take it back to a whitening direction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.text import id_type, map_rows
from ratewright.storage import materialise

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
BLOCK = 8192  # rows of a block
FAN_IN = 32  # triangular factors reduced at a time
EPS = np.finfo("float64").eps
TINY = np.finfo("float64").tiny
CLUSTER = 1e-3  # relative gap below which directions are made orthogonal by hand
RANK = 1e-12  # singular values below this share of the largest count as 0


# -- bidiagonal form -----------------------------------------------------------------------------


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """u and its factor such that x - factor * u (u.x) has only a first entry."""
    u = x.copy()
    size = np.linalg.norm(x)
    if size == 0 or not np.any(x[1:]):
        return u, 0.0
    u[0] += np.copysign(size, x[0])
    return u, 2.0 / (u @ u)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, P) with r = U B P^T and orthogonal U, P."""
    a, d = r.astype("float64").copy(), r.shape[1]
    p = np.eye(d)
    for k in range(d):
        u, factor = _reflector(a[k:, k])
        if factor:
            a[k:, k:] -= np.outer(factor * u, u @ a[k:, k:])
        if k < d - 2:
            u, factor = _reflector(a[k, k + 1 :])
            if factor:
                a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ u, factor * u)
                p[:, k + 1 :] -= np.outer(p[:, k + 1 :] @ u, factor * u)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), p


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd step with a shift: the new q and e, and the values d whose signs tell if it was too large."""
    qs, es, ds = [], [], []
    d = q[0] - shift
    for i in range(len(e)):
        ds.append(d)
        total = d + e[i]
        qs.append(total)
        ratio = q[i + 1] / total if total else float("inf")
        es.append(e[i] * ratio)
        d = d * ratio - shift
    ds.append(d)
    qs.append(d)
    return qs, es, ds


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, of the upper bidiagonal matrix with these entries."""
    todo = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    found: list[float] = []
    while todo:
        q, e, moved = todo.pop()
        while len(q) > 1:
            # an entry above the diagonal that no longer counts parts the matrix
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS**2 * (moved + min(q[i], q[i + 1])) or e[i] < TINY), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if q[0] < q[-1]:  # the small values are to come out at the end
                q, e = q[::-1], e[::-1]
            plain = _transform(q, e, 0.0)
            # 1 / d are the diagonal of an inverse whose trace is the sum of 1 / value: a safe bound from below
            if min(plain[2]) <= TINY:
                q, e, _ = plain
                q = [max(x, 0.0) for x in q]
                if q[-1] <= TINY:
                    found.append(moved + max(q[-1], 0.0))
                    q, e = q[:-1], e[:-1]
                continue
            shift = (1.0 - 1e-10) / sum(1.0 / x for x in plain[2])
            shifted = _transform(q, e, shift)
            if min(shifted[2]) < 0 or not all(np.isfinite(shifted[0])):
                shifted, shift = plain, 0.0
            q, e, moved = shifted[0], shifted[1], moved + shift
        found += [moved + max(x, 0.0) for x in q]
    return np.sort(np.array(found))[::-1]


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector of B^T B for an eigenvalue, from the twisted factorisation with the least twist."""
    n = len(diagonal)
    if n == 1:
        return np.ones(1)
    size = max(np.abs(diagonal).max(), np.abs(above).max(), TINY)
    a = np.where(np.abs(diagonal) > EPS * EPS * size, diagonal, EPS * EPS * size)
    pivot, ell = a * a, above / a[:-1]  # B^T B = L D L^T
    guard = EPS * EPS * size * size
    down, s = np.empty(n - 1), np.empty(n)  # stationary: L+ and its remainders
    s[0] = -value
    for i in range(n - 1):
        total = s[i] + pivot[i] or guard
        down[i] = pivot[i] * ell[i] / total
        s[i + 1] = down[i] * ell[i] * s[i] - value
    up, p = np.empty(n - 1), np.empty(n)  # progressive: U- and its remainders
    p[-1] = pivot[-1] - value
    for i in range(n - 2, -1, -1):
        total = pivot[i] * ell[i] ** 2 + p[i + 1] or guard
        ratio = pivot[i] / total
        up[i] = ell[i] * ratio
        p[i] = p[i + 1] * ratio - value
    r = int(np.abs(s + p + value).argmin())
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def _orthogonal(z: np.ndarray, near: list[np.ndarray], matrix: np.ndarray, value: float) -> np.ndarray:
    """z without its parts along the vectors of near eigenvalues; where hardly anything is left, a vector by inverse
    iteration from elsewhere."""

    def less(x):
        for _ in range(2):
            for other in near:
                x = x - (other @ x) * other
        return x

    rest = less(z)
    if np.linalg.norm(rest) > 0.1:
        return rest / np.linalg.norm(rest)
    rest = less(np.random.default_rng(len(near)).standard_normal(len(z)))
    moved = matrix - (value + 4 * EPS * np.abs(matrix).max()) * np.eye(len(z))
    for _ in range(4):
        rest = less(np.linalg.solve(moved, rest / np.linalg.norm(rest)))
    return rest / np.linalg.norm(rest)


def decompose(r: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """(squared singular values, right singular vectors as columns, sum of all squares) of a triangular factor: the first
    ``most``, without those that count as 0."""
    d = r.shape[1]
    size = float(np.abs(r).max()) if r.size else 0.0
    if not size:
        return np.empty(0), np.empty((d, 0)), 0.0
    diagonal, above, p = bidiagonal(r / size)
    parts = np.abs(above) <= EPS * (np.abs(diagonal[:-1]) + np.abs(diagonal[1:]))
    edges = [0, *(np.flatnonzero(parts) + 1), d]
    pairs = []  # (value, first, last) of every block
    for first, last in zip(edges, edges[1:]):
        pairs += [(v, first, last) for v in dqds(diagonal[first:last], above[first : last - 1])]
    pairs.sort(reverse=True)
    total = sum(v for v, _, _ in pairs)
    kept = [x for x in pairs[:most] if x[0] > RANK**2 * pairs[0][0]]
    columns: list[np.ndarray] = []
    for i, (value, first, last) in enumerate(kept):
        a, b = diagonal[first:last], above[first : last - 1]
        z = twisted_vector(a, b, value)
        near = [
            columns[j][first:last] for j in range(i) if kept[j][1] == first and kept[j][0] - value <= CLUSTER * kept[j][0]
        ]
        if near or not np.isfinite(z).all():
            full = np.diag(a) + np.diag(b, 1)
            z = _orthogonal(np.nan_to_num(z, nan=0.0, posinf=0.0, neginf=0.0), near, full.T @ full, value)
        column = np.zeros(d)
        column[first:last] = z
        columns.append(column)
    vectors = p @ np.column_stack(columns) if columns else np.empty((d, 0))
    return np.array([v for v, _, _ in kept]) * size**2, vectors, total * size**2


# -- on tables -----------------------------------------------------------------------------------


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and x, floor(scale * c) + SHIFT of each entry c as long; rows whose vector is NULL or holds NULL or
    non-finite entries are left out."""
    x = F.col(vector_col)
    usable = x.isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    )
    rows = vectors.select(F.col(id_col).alias("vec_id"), x.alias("c")).where(F.coalesce(usable, F.lit(False)))
    entry = F.transform("c", lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long") + F.lit(SHIFT).cast("long"))
    return rows.select("vec_id", entry.alias("x"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` entries; a shorter vector is filled up with the place of 0."""
    offsets = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if (offsets == width).all():
        return flat.reshape(len(lists), width)
    out = np.full((len(lists), width), SHIFT, "int64")
    out[np.arange(width)[None] < offsets[:, None]] = flat
    return out


def _blocks(slabs: Iterator, width: int) -> Iterator[np.ndarray]:
    held, rows = [], 0
    for (lists,) in slabs:
        held.append(_matrix(lists, width))
        rows += len(lists)
        if rows >= BLOCK:
            yield np.vstack(held)
            held, rows = [], 0
    if rows:
        yield np.vstack(held)


@dataclass
class Whitening:
    """What is learned: n vectors with sums by dimension, the first eigenvalues of their covariance (divisor n), unit
    eigenvectors as columns, the trace, and how far the whitened vectors' covariance is from the identity."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    directions: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def width(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact; as Python numbers where 64 bits might not do."""
        largest = int(np.abs(x).max(initial=0)) * self.n + int(np.abs(self.sums).max(initial=0))
        wide = largest >= 1 << 62
        x, sums = (x.astype(object), self.sums.astype(object)) if wide else (x, self.sums)
        return x * self.n - sums

    def deviation(self, centred: np.ndarray) -> np.ndarray:
        largest = int(np.abs(centred).max(initial=0))
        if largest * largest * max(1, self.width) >= 1 << 63:
            centred = centred.astype(object)
        return (centred * centred).sum(axis=1)

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype("float64") @ self.directions / np.sqrt(self.values)


def _triangle(held: np.ndarray) -> np.ndarray:
    """The square triangular factor of rows, filled up with zeros."""
    r = np.linalg.qr(held, mode="r")
    return np.vstack([r, np.zeros((held.shape[1] - len(r), held.shape[1]))]) if len(r) < held.shape[1] else r


def triangular_factor(rows: DataFrame, learned: Whitening) -> np.ndarray:
    """R of the QR of all centred rows: one factor a task, then FAN_IN factors at a time."""
    width = learned.width

    def run(slabs):
        r = None
        for block in _blocks(slabs, width):
            y = (learned.centred(block) / learned.n).astype("float64")
            r = _triangle(y if r is None else np.vstack([r, y]))
        if r is not None:
            yield {"part": [TaskContext.get().partitionId()], "r": [r.ravel()]}

    def reduce(parts: pd.DataFrame) -> pd.DataFrame:
        r = _triangle(np.vstack([np.asarray(x, "float64").reshape(width, width) for x in parts["r"]]))
        return pd.DataFrame({"part": [int(parts["part"].iat[0]) // FAN_IN], "r": [r.ravel()]})

    factors = map_rows(rows, ["x"], "part int, r array<double>", run)
    many = rows.rdd.getNumPartitions()
    while many > 1:
        factors = factors.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(reduce, "part int, r array<double>")
        many = -(-many // FAN_IN)
    found = factors.collect()  # one row
    return np.asarray(found[0]["r"]).reshape(width, width) if found else np.zeros((width, width))


def _sums(rows: DataFrame, width: int) -> np.ndarray:
    def run(slabs):
        total = None
        for block in _blocks(slabs, width):
            part = block.sum(axis=0)
            total = part if total is None else total + part
        if total is not None:
            yield {"dimension": np.arange(width), "s": total}

    summed = map_rows(rows, ["x"], "dimension int, s long", run).groupBy("dimension").agg(F.sum("s").alias("s"))
    out = np.zeros(width, "int64")
    for r in summed.collect():  # a row per dimension
        out[r["dimension"]] = r["s"]
    return out


def identity_error(rows: DataFrame, learned: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity."""
    k = len(learned.values)

    def run(slabs):
        total = None
        for block in _blocks(slabs, learned.width):
            w = np.column_stack([learned.whiten(learned.centred(block)), np.ones(len(block))])
            total = w.T @ w if total is None else total + w.T @ w
        if total is not None:
            yield {"at": np.arange(total.size), "s": total.ravel()}

    summed = map_rows(rows, ["x"], "at int, s double", run).groupBy("at").agg(F.sum("s").alias("s"))
    moments = np.zeros((k + 1) ** 2)
    for r in summed.collect():  # (components + 1)^2 rows
        moments[r["at"]] = r["s"]
    moments = moments.reshape(k + 1, k + 1) / learned.n
    covariance = moments[:k, :k] - np.outer(moments[k, :k], moments[k, :k])
    return float(np.abs(covariance - np.eye(k)).max(initial=0.0))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Learn from the distinct vectors of ``rows`` (``scaled``), each counted once."""
    shapes = rows.agg(F.max(F.size("x")).alias("width")).first()
    width = shapes["width"] or 0
    filler = F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - F.size("x"))
    full = F.when(F.size("x") < width, F.concat("x", filler)).otherwise(F.col("x"))
    distinct = materialise(rows.select(full.alias("x")).distinct(), "distinct_vectors")
    n = distinct.count()
    learned = Whitening(n, np.zeros(width, "int64"), np.empty(0), np.empty((width, 0)), 0.0)
    if not n or not width:
        return learned
    learned.sums = _sums(distinct, width)
    squares, learned.directions, total = decompose(triangular_factor(distinct, learned), components)
    learned.values, learned.trace = squares / n, total / n
    learned.identity_error = identity_error(distinct, learned)
    return learned


def transform(rows: DataFrame, learned: Whitening) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row per row and component."""
    k, width = len(learned.values), learned.width
    schema = f"vec_id {id_type(rows, 'vec_id')}, component int, n long, deviation long, whitened double, "
    schema += "explained double, identity_error double"

    def run(slabs):
        for ids, lists in slabs:
            centred = learned.centred(_matrix(lists, width))
            many = len(ids) * k
            yield {
                "vec_id": ids.take(pa.array(np.repeat(np.arange(len(ids)), k))),
                "component": np.tile(np.arange(1, k + 1, dtype="int32"), len(ids)),
                "n": np.full(many, learned.n),
                "deviation": np.repeat(learned.deviation(centred), k),
                "whitened": learned.whiten(centred).ravel(),
                "explained": np.tile(learned.values / learned.trace if k else learned.values, len(ids)),
                "identity_error": np.full(many, learned.identity_error),
            }

    return map_rows(rows, ["vec_id", "x"], schema, run)


def whitened(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """The first ``components`` whitened coordinates of every usable vector, fitted on the distinct ones.

    Vectors that are NULL or hold NULL or non-finite entries give no rows. Shorter vectors count as filled up with zeros,
    repeated ones are fitted once and each give rows, NULL ids stay NULL. Directions without variance (fewer
    dimensions or distinct vectors than components, constant entries) give no rows, so one distinct vector, or an
    empty table, gives none. Entries may be as large as 10^15 in size; a deviation beyond 64 bits is an error. Other columns are not read.
    """
    rows = materialise(scaled(vectors, id_col, vector_col), "scaled_vectors")
    return transform(rows, fit(rows, components))
