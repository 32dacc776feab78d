"""Whitening of embeddings by incremental eigendecomposition.

Each partition keeps the spectrum (eigenvalues and eigenvectors) of its own centred scatter and brings rows in by centred
rank-one updates: the update in eigenbasis is the secular equation ``1 + rho * sum z_i^2 / (l_i - m) = 0``, solved between
its poles after deflation of components that the update does not touch and of equal eigenvalues. A block of rows is
one update each for the rows of its triangular factor (their outer products add up to the block's scatter) and one for the
shift of the mean; ``block=1`` takes the rows themselves. Spectra of partitions are combined the same way, eight at a time:
the other's scaled eigenvectors and the difference of the means are successive rank-one updates.

The basis that comes out is refined by Rayleigh-Ritz: one pass over the rows projects the covariance onto the basis, the
small matrix is diagonalised and the basis turned by it. The next pass does the same with the turned basis, which
measures how far the whitened rows' covariance is from the identity; passes go on until that is ``EXACT`` or better.
Matrices of dimension x dimension are all that a task or the driver holds besides a batch of rows.

Defined results: rows whose vector is null, or holds nulls, NaN or infinite entries are left out, and so are rows of
another length than most rows have (the greater length on a tie). Entries are whole numbers ``floor(scale * c) + shift`` and
are taken at +-2**52 beyond these. Repeated rows and null ids count like others. Fewer entries than wanted components give
as many components as entries. A component without variance has null whitened values and counts in no identity error.
An empty table has no rows and a model of zero dimensions. Extra columns are not read.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from parcelwise.session import reliable

BLOCK = 2048
FAN_IN = 8
#: Passes of refinement end when the whitened covariance is this close to the identity, or after MOST_PASSES.
EXACT, MOST_PASSES = 1e-9, 6
#: A component is without variance when its eigenvalue is below this share of the greatest.
FLAT = 1e-13
LIMIT = float(1 << 52)
EPS = np.finfo(float).eps

SPECTRUM = "part bigint, n bigint, sums array<bigint>, eigenvalues array<double>, vectors array<double>"


def secular_roots(poles: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho * sum z2 / (poles - m)``, one after each pole, as (nearest pole's number, distance from it).

    ``poles`` rise strictly, ``z2`` are positive and add up to one. Each step fits the two neighbouring poles to the value
    and the slopes on both sides; a step that leaves the bracket known so far halves it.
    """
    k = len(poles)
    gap = np.append(np.diff(poles), rho)
    at = np.arange(k)
    middle = poles + gap / 2
    value = 1 + rho * np.sum(z2 / (poles - middle[:, None]), axis=1)
    near = np.where((value >= 0) | (at == k - 1), at, at + 1)
    distance = poles - poles[near][:, None]
    mine, following = distance[at, at], np.append(distance[at[:-1], at[:-1] + 1], rho)
    low = np.where(near == at, 0.0, -gap / 2)
    high = np.where(near == at, np.where(at == k - 1, gap, gap / 2), 0.0)
    left = at[None, :] <= at[:, None]
    tau = (low + high) / 2
    for _ in range(80):
        to = distance - tau[:, None]
        terms = rho * z2 / to
        slopes = terms / to
        value = 1 + terms.sum(axis=1)
        low, high = np.where(value < 0, tau, low), np.where(value < 0, high, tau)
        done = (np.abs(value) <= 4 * EPS * (1 + np.abs(terms).sum(axis=1))) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        down = np.where(left, slopes, 0).sum(axis=1)
        up = slopes.sum(axis=1) - down
        a, b = mine - tau, following - tau
        s, t = down * a * a, up * b * b
        c = value - down * a - up * b
        # c (a - y)(b - y) + s (b - y) + t (a - y) = 0 for the step y
        p, q = -(c * (a + b) + s + t), c * a * b + s * b + t * a
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(p * p - 4 * c * q, 0))
            first, second = 2 * q / (-p + root), 2 * q / (-p - root)
        fits = lambda y: np.isfinite(y) & (tau + y > low) & (tau + y < high)
        step = np.where(fits(first), tau + np.nan_to_num(first), np.where(fits(second), tau + np.nan_to_num(second), (low + high) / 2))
        tau = np.where(done, tau, step)
    return near, tau


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of ``vectors diag(values) vectors' + rho v v'`` for rho >= 0."""
    z = vectors.T @ v
    norm = float(np.linalg.norm(z))
    rho = rho * norm * norm
    if not rho > 0:
        return values, vectors
    z = z / norm
    vectors = vectors.copy()
    small = 8 * EPS * max(abs(values[-1]), abs(values[0]), rho)
    active = [int(i) for i in np.flatnonzero(rho * np.abs(z) > small)]
    kept: list[int] = []
    for i in active:  # of equal eigenvalues a rotation leaves one that the update touches
        if kept and values[i] - values[kept[-1]] <= small:
            j = kept.pop()
            r = np.hypot(z[i], z[j])
            c, s = z[i] / r, z[j] / r
            x, y = vectors[:, j].copy(), vectors[:, i].copy()
            vectors[:, j], vectors[:, i] = c * x - s * y, s * x + c * y
            z[i], z[j] = r, 0.0
        kept.append(i)
    if not kept:
        return values, vectors
    k = np.array(kept)
    poles, zk = values[k], z[k]
    scale = float(np.sum(zk * zk))
    near, tau = secular_roots(poles, zk * zk / scale, rho * scale)
    # roots minus poles, without cancellation; then the z for which these roots are exact, so the vectors are orthogonal
    to_root = (poles[near][None, :] - poles[:, None]) + tau[None, :]
    apart = poles[None, :] - poles[:, None]
    np.fill_diagonal(apart, 1.0)
    ratio = to_root / apart
    np.fill_diagonal(ratio, np.diagonal(to_root))
    exact = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.where(zk < 0, -1.0, 1.0)
    turn = exact[:, None] / -to_root
    turn /= np.linalg.norm(turn, axis=0)
    vectors[:, k] = vectors[:, k] @ turn
    values = values.copy()
    values[k] = poles[near] + tau
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Count, exact sums and the eigen-decomposed centred scatter of some rows."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size, np.int64), np.zeros(size), np.eye(size))

    def _shift(self, n: int, sums: np.ndarray) -> None:
        """Take in n rows whose own scatter is already here: one update for the difference of the means."""
        if self.n and n:
            apart = sums / n - self.sums / self.n
            self.values, self.vectors = rank_one(self.values, self.vectors, apart, self.n * n / (self.n + n))
        self.n, self.sums = self.n + n, self.sums + sums

    def add_rows(self, x: np.ndarray, block: int = BLOCK) -> None:
        for i in range(0, len(x), block):
            rows = x[i : i + block]
            sums = rows.sum(axis=0)
            if len(rows) > 1:
                for r in np.linalg.qr(rows - sums / len(rows), mode="r"):
                    self.values, self.vectors = rank_one(self.values, self.vectors, r)
            self._shift(len(rows), sums)

    def add(self, other: Spectrum) -> None:
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        self._shift(other.n, other.sums)

    def row(self, part: int) -> pa.RecordBatch:
        lists = [[self.sums.tolist()], [self.values.tolist()], [self.vectors.ravel().tolist()]]
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([self.n], pa.int64()), pa.array(lists[0], pa.list_(pa.int64())), *[pa.array(x, pa.list_(pa.float64())) for x in lists[1:]]],
            names=["part", "n", "sums", "eigenvalues", "vectors"],
        )

    @classmethod
    def of(cls, row) -> Spectrum:
        values = np.array(row["eigenvalues"], float)
        return cls(row["n"], np.array(row["sums"], np.int64), values, np.array(row["vectors"], float).reshape(len(values), len(values)))


@dataclass
class Whitening:
    """A fitted whitening: ``components`` are the columns' unit eigenvectors by falling eigenvalue."""

    n: int
    sums: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float
    scale: int
    shift: int


def usable(df: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id") -> tuple[DataFrame, int]:
    """(vec_id, vector) of the rows that take part, and their length."""
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vector"))
    whole = rows.where("vector IS NOT NULL AND NOT exists(vector, c -> c IS NULL OR isnan(c) OR abs(c) = double('Infinity')) AND size(vector) > 0")
    sizes = whole.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = sizes[0]["size"] if sizes else 0
    return whole.where(F.size("vector") == size), size


def _whole(column: pa.Array, size: int, scale: int, shift: int) -> np.ndarray:
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return np.clip(np.floor(scale * entries), -LIMIT, LIMIT).astype(np.int64) + shift


def _exact(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums`` without rounding: 64-bit numbers where they are wide enough, else Python's."""
    if len(x) and n * int(np.abs(x).max()) + int(np.abs(sums).max()) >= 1 << 62:
        return n * x.astype(object) - sums.astype(object)
    return n * x - sums


def spectra(rows: DataFrame, size: int, scale: int, shift: int, block: int = BLOCK) -> DataFrame:
    """One spectrum for each partition that has rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Spectrum.empty(size)
        for batch in batches:
            found.add_rows(_whole(batch.column(0), size, scale, shift), block)
        if found.n:
            yield found.row(TaskContext.get().partitionId())

    return rows.select("vector").mapInArrow(work, SPECTRUM)


def combine(parts: DataFrame, n_parts: int) -> Spectrum:
    """All spectra, numbered below ``n_parts``, as one: FAN_IN at a time in the order of their numbers."""

    def work(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        found = Spectrum.of(rows[0])
        for row in rows[1:]:
            found.add(Spectrum.of(row))
        return pa.Table.from_batches([found.row(rows[0]["part"] // FAN_IN)])

    while n_parts > 1:
        parts = parts.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(work, SPECTRUM)
        n_parts = -(-n_parts // FAN_IN)
    return Spectrum.of(parts.collect()[0])


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return _exact(x, n, sums).astype(np.float64) / n


def projected_covariance(rows: DataFrame, basis: np.ndarray, n: int, sums: np.ndarray, scale: int, shift: int) -> np.ndarray:
    """``basis' V basis`` for the rows' covariance V: each partition sends one upper triangle, added up by Spark."""
    shared = rows.sparkSession.sparkContext.broadcast((basis, sums))
    upper = np.triu_indices(basis.shape[1])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, sums = shared.value
        total = np.zeros((basis.shape[1], basis.shape[1]))
        for batch in batches:
            y = _centred(_whole(batch.column(0), len(sums), scale, shift), n, sums) @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(upper[0]), pa.array(upper[1]), pa.array(total[upper])], names=["i", "j", "h"])

    cells = rows.select("vector").mapInArrow(work, "i bigint, j bigint, h double").groupBy("i", "j").agg(F.sum("h").alias("h")).toArrow()
    out = np.zeros((basis.shape[1], basis.shape[1]))
    i, j, h = (cells[c].to_numpy() for c in ("i", "j", "h"))
    out[i, j] = h / n
    out[j, i] = h / n
    return out


def fit(df: DataFrame, components: int = 8, vec_col: str = "embedding", scale: int = 1024, shift: int = 100_000, block: int = BLOCK) -> Whitening:
    """Fit on all rows with a usable vector; ``components`` are the leading ones that are kept."""
    rows, size = usable(df, vec_col, vec_col)
    nothing = Whitening(0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0)), 0.0, 0.0, scale, shift)
    if not size:
        return nothing
    parts = reliable(spectra(rows, size, scale, shift, block))
    whole = combine(parts, 1 + parts.agg(F.max("part")).collect()[0][0])
    basis = whole.vectors[:, ::-1]
    kept = min(components, size)
    for turn in range(MOST_PASSES):
        h = projected_covariance(rows, basis, whole.n, whole.sums, scale, shift)
        values = np.diagonal(h)[:kept]
        live = values > FLAT * max(values.max(initial=0.0), 0.0)
        scaled = h[:kept, :kept][np.ix_(live, live)] / np.sqrt(np.outer(values[live], values[live]))
        error = float(np.abs(scaled - np.eye(live.sum())).max(initial=0.0))
        if turn and error <= EXACT:
            break
        if turn == MOST_PASSES - 1:
            logging.getLogger(__name__).warning("whitened covariance is %g from the identity after %d passes", error, MOST_PASSES)
            break
        found, rotation = np.linalg.eigh(h)
        basis = np.linalg.qr(basis @ rotation[:, ::-1])[0]
    values = np.where(live, values, 0.0)
    leading = basis[:, :kept]
    leading = leading * np.where(leading[np.abs(leading).argmax(axis=0), np.arange(kept)] < 0, -1.0, 1.0)
    # the error of the values as they are used: whitened rows have this covariance apart from rounding
    return Whitening(whole.n, whole.sums, values, leading, float(np.trace(h)), error, scale, shift)


def whiten(df: DataFrame, model: Whitening, vec_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """(vec_id, deviation, whitened) of each row with a usable vector of the model's length.

    ``whitened`` has one entry a component (null without variance); ``deviation`` is the exact sum of ``(n * x - S)**2`` as
    decimal(38,0).
    """
    rows, _ = usable(df, vec_col, id_col)
    size = len(model.sums)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    live = model.eigenvalues > 0
    factor = model.components / np.sqrt(np.where(live, model.eigenvalues, 1.0)) if size else np.zeros((0, 0))
    shared = df.sparkSession.sparkContext.broadcast((factor, model.sums))
    n, scale, shift = model.n, model.scale, model.shift

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, sums = shared.value
        for batch in batches:
            a = _exact(_whole(batch.column(1), size, scale, shift), n, sums)
            if a.dtype != object and len(a) and size * int(np.abs(a).max()) ** 2 < 1 << 63:
                deviation = pa.array((a * a).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                sums2 = (a.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([int(s) if s < 10**38 else None for s in sums2], pa.decimal128(38, 0))
            out = (a.astype(np.float64) / n) @ factor
            gaps = np.broadcast_to(~live, out.shape).ravel()
            whitened = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel(), mask=gaps))
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, whitened], names=["vec_id", "deviation", "whitened"])

    return rows.where(F.size("vector") == size).mapInArrow(work, f"vec_id {id_type}, deviation decimal(38,0), whitened array<double>")
