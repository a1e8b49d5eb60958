"""Whitened embeddings by an incremental eigendecomposition.

Vectors become whole numbers x = floor(64 * c) + OFFSET. Every task goes over its vectors once and keeps the spectrum of
their scatter about their running mean: each vector is a rank-one update, solved by the secular equation of the spectrum
after deflation of components the vector does not touch and of equal eigenvalues; equal vectors of a tile are one
weighted update. Spectra of two parts are combined by one update for the distance of their means and one for each
eigenpair of the second, in a tree of bounded groups. Up to RANK eigenpairs are kept.

The leading pairs are then refined over all vectors: one pass multiplies the covariance with the basis, the Rayleigh-Ritz
values and vectors of that basis come with their residuals, and while a residual is above TOLERANCE of the largest
eigenvalue the basis is widened by the residuals and another pass follows. Everything is centred on the exact mean before
it is multiplied. What reaches the driver is one spectrum and one basis (dimensions x at most 160 columns).

Rows with a vector that takes no part (`vectors`) are left out; a null id is returned as it is, repeated rows are
vectors of their own, further columns are ignored, no rows give no rows. `deviation` is null where it does not fit into
64 bits. A component without variance (fewer distinct vectors than components) has a null `whitened` and `explained` 0;
where nothing varies at all, `explained` and `identity_error` are null as well."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from claimwright.llm.common import stored
from claimwright.llm.vectors import matrix, shape, tiles

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Eigenpairs kept by a spectrum, columns of the basis beyond the components, spectra combined at once.
RANK, SPARE, FAN_IN = 128, 8, 16
#: Residual of a refined pair, as part of the largest eigenvalue, and the most passes that are made for it.
TOLERANCE, PASSES = 1e-13, 8
#: Columns of a widened basis at most, as a multiple of components and spare ones.
WIDEST = 4
EPS = float(np.finfo(float).eps)

SPECTRUM = "part long, n long, mean binary, eigenvalues binary, vectors binary"


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z^2 / (d - x)) for rising distinct d, rho > 0 and z without zeros: the roots, each between
    its d and the next, and the differences d[j] - root[i], which keep their digits next to a pole.

    Every root is sought as its distance from the nearer pole, by steps that interpolate the function with both poles
    of its interval; a step that leaves the bracket is replaced by the bracket's middle."""
    k = len(d)
    z2 = z * z
    upper = np.append(d[1:], d[-1] + rho * z2.sum())
    gap = upper - d
    # sign at the middle of the interval tells the nearer pole; the last interval has one pole only
    middle = d + gap / 2
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        inverse = 1 / (d - middle[:, None])
        at_middle = 1 / rho + inverse @ z2
        right = (at_middle < 0) & (np.arange(k) < k - 1)
        origin = np.where(right, upper, d)
        poles = d - origin[:, None]  # exact zero at the pole of origin
        low, high = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, np.where(np.arange(k) < k - 1, gap / 2, gap))
        left = np.tri(k)
        ends = np.append(poles[np.arange(k - 1), np.arange(1, k)], gap[-1])
        own = poles[np.arange(k), np.arange(k)]
        # first guess: the two poles of the interval as they are, all others as at its middle
        next2 = np.append(z2[1:], 0.0)
        c = at_middle + (z2 - next2) * 2 / gap
        b, a = c * (own + ends) + z2 + next2, c * own * ends + z2 * ends + next2 * own
        q = (b + np.copysign(np.sqrt(np.maximum(b * b - 4 * a * c, 0)), b)) / 2
        x = np.where((q / c > low) & (q / c < high), q / c, a / q)
        x = np.where((x > low) & (x < high), x, (low + high) / 2)
        for _ in range(60):
            inverse = 1 / (poles - x[:, None])
            f = 1 / rho + inverse @ z2
            done = np.abs(f) <= 4 * EPS * k * (1 / rho + np.abs(inverse) @ z2)
            below = f < 0
            low, high = np.where(below, x, low), np.where(below, high, x)
            done |= (high - low) <= 2 * EPS * np.maximum(np.abs(low), np.abs(high))
            if done.all():
                break
            inverse *= inverse
            slope = inverse @ z2
            inverse *= left
            psi = inverse @ z2
            phi = slope - psi
            a1, a2 = own - x, ends - x
            a = (a1 + a2) * f - a1 * a2 * slope
            b = a1 * a2 * f
            c = f - a1 * psi - a2 * phi
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            eta = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            moved = x + eta
            inside = np.isfinite(moved) & (moved > low) & (moved < high)
            x = np.where(done, x, np.where(inside, moved, (low + high) / 2))
    return origin + x, poles - x[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of vectors * diag(values) * vectors' + rho * v * v', for v = vectors * z; values rise, also the new."""
    size = max(float(np.abs(values).max(initial=0)), rho * float(z @ z))
    tolerance = 8 * EPS * size
    if not len(values) or rho * float(z @ z) <= EPS * EPS * size:
        return values, vectors
    # equal eigenvalues: turn their vectors so that z touches only the last of each run
    close = np.diff(values) <= tolerance
    if close.any():
        vectors, z = vectors.copy(), z.copy()
        starts = np.flatnonzero(close & ~np.append(False, close[:-1]))
        for s in starts:
            e = s + 1
            while e < len(close) and close[e]:
                e += 1
            run = slice(s, e + 1)
            norm = np.linalg.norm(z[run])
            if norm == 0:
                continue
            u = z[run].copy()
            u[-1] += norm if u[-1] >= 0 else -norm
            turned = vectors[:, run]
            vectors[:, run] = turned - np.outer(turned @ u, u) * (2 / (u @ u))
            z[run] = 0
            z[e] = -norm if u[-1] >= 0 else norm
    active = np.flatnonzero(rho * np.abs(z) * np.linalg.norm(z) > tolerance)
    if not len(active):
        return values, vectors
    d, w = values[active], z[active]
    roots, delta = secular_roots(d, w, rho)
    # the z for which these roots are exact (Loewner's formula): vectors are then orthogonal to working precision
    spread = d[:, None] - d
    np.fill_diagonal(spread, 1.0)
    exact = np.sqrt(np.abs(np.prod(-delta / spread, axis=0))) * np.sign(w)
    turn = exact / delta
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    values, out = values.copy(), vectors.copy()
    values[active] = roots
    out[:, active] = vectors[:, active] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], out[:, order]


class Spectrum:
    """Count, mean and leading eigenpairs of the scatter about the mean of the vectors seen."""

    def __init__(self, width: int, rank: int = RANK):
        self.n, self.rank = 0, rank
        self.mean, self.values, self.vectors = np.zeros(width), np.zeros(0), np.zeros((width, 0))

    def update(self, v: np.ndarray, rho: float) -> None:
        """Adds rho * v * v' to the scatter."""
        z = self.vectors.T @ v
        if len(self.values) < len(v):
            rest = v - self.vectors @ z
            again = self.vectors.T @ rest  # a second time: orthogonal to working precision
            rest -= self.vectors @ again
            z += again
            beta = np.linalg.norm(rest)
            if beta > 64 * EPS * np.linalg.norm(v):
                self.values = np.append(0.0, self.values)
                self.vectors = np.column_stack([rest / beta, self.vectors])
                z = np.append(beta, z)
        self.values, self.vectors = rank_one(self.values, self.vectors, z, rho)
        if len(self.values) > self.rank:
            self.values, self.vectors = self.values[1:], self.vectors[:, 1:]

    def add(self, x: np.ndarray, weight: int = 1) -> None:
        """A vector that occurs `weight` times."""
        away = x - self.mean
        self.update(away, self.n * weight / (self.n + weight))
        self.n += weight
        self.mean = self.mean + away * (weight / self.n)

    def merge(self, other: Spectrum) -> None:
        total = self.n + other.n
        if not other.n:
            return
        away = other.mean - self.mean
        self.update(away, self.n * other.n / total)
        for value, vector in zip(other.values[::-1], other.vectors.T[::-1]):
            if value > 0:
                self.update(vector, value)
        self.mean = self.mean + away * (other.n / total)
        self.n = total

    def row(self, part: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([self.n], pa.int64()),
             *[pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in (self.mean, self.values, self.vectors)]],
            names=["part", "n", "mean", "eigenvalues", "vectors"])

    @classmethod
    def of(cls, row: dict, rank: int = RANK) -> Spectrum:
        mean = np.frombuffer(row["mean"])
        out = cls(len(mean), rank)
        out.n, out.mean, out.values = row["n"], mean, np.frombuffer(row["eigenvalues"])
        out.vectors = np.frombuffer(row["vectors"]).reshape(len(mean), len(out.values))
        return out


def spectra(tiled: DataFrame, width: int, rank: int = RANK) -> DataFrame:
    """One spectrum of each task's vectors, in units of x - OFFSET."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = Spectrum(width, rank), 0
        for batch in batches:
            for tile in batch.to_pylist():
                part = tile["part"]
                rows, counts = np.unique(matrix(tile, width), axis=0, return_counts=True)
                for x, count in zip(rows.astype(float), counts):
                    own.add(x, int(count))
        if own.n:
            yield own.row(part)

    return tiled.withColumn("part", F.monotonically_increasing_id()).mapInArrow(grow, SPECTRUM)


def combined(parts: DataFrame, rank: int = RANK, fan_in: int = FAN_IN) -> Spectrum | None:
    """One spectrum of all, combined in groups of `fan_in`, each level a stored table."""

    def combine(table: pa.Table) -> pa.Table:
        rows = table.sort_by("part").to_pylist()
        first = Spectrum.of(rows[0], rank)
        for row in rows[1:]:
            first.merge(Spectrum.of(row, rank))
        return pa.Table.from_batches([first.row(rows[0]["bin"])])

    while True:
        parts = stored(parts, "spectra")
        count = parts.count()
        if count <= 1:
            break
        # places of the parts in their order: a few numbers for each task that made one
        place = F.row_number().over(Window.orderBy("part")) - 1
        places = parts.select("part").select("part", F.floor(place / fan_in).alias("bin"))
        parts = parts.join(F.broadcast(places), "part").groupBy("bin").applyInArrow(combine, SPECTRUM)
    row = parts.first()
    return None if row is None else Spectrum.of(row.asDict(), rank)


def _summed(tiled: DataFrame, cells: Callable[[dict], np.ndarray]) -> np.ndarray:
    """The sum over all tiles of an array that `cells` makes of a tile; its size must not grow with the rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for tile in batch.to_pylist():
                own = cells(tile).ravel()
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["cell", "value"])

    kind = "long" if cells.__annotations__.get("whole") else "double"
    sums = tiled.mapInArrow(add, f"cell long, value {kind}").groupBy("cell").agg(F.sum("value").alias("value"))
    return np.array([r["value"] for r in sorted(sums.collect())])


def dimension_sums(tiled: DataFrame, width: int) -> list[int]:
    """Exact sum of every dimension of x - OFFSET."""

    def sums(tile: dict) -> np.ndarray:
        return matrix(tile, width).sum(0)

    sums.__annotations__["whole"] = True
    return [int(s) for s in _summed(tiled, sums)]


def refined(tiled: DataFrame, basis: np.ndarray, mean: np.ndarray, n: int, components: int) -> tuple:
    """Leading eigenvalues (falling) and unit eigenvectors of the covariance within the basis, widened until their
    residuals are small, and the covariance's trace."""
    width = len(mean)
    for _ in range(PASSES):
        def product(tile: dict, basis=basis) -> np.ndarray:
            centred = matrix(tile, width) - mean
            return np.append((centred.T @ (centred @ basis)).ravel(), (centred * centred).sum())

        sums = _summed(tiled, product) / n
        image, trace = sums[:-1].reshape(basis.shape), float(sums[-1])
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        vectors = basis @ turn
        residuals = (image @ turn - vectors * values)[:, :components]
        wide = np.linalg.norm(residuals, axis=0) > TOLERANCE * max(values[0], 0.0)
        if not wide.any() or basis.shape[1] >= width:
            break
        fresh = residuals[:, wide]
        for _ in range(2):
            fresh = fresh - vectors @ (vectors.T @ fresh)
            fresh = np.linalg.qr(fresh)[0]
        most = min(width, WIDEST * (components + SPARE))  # beyond it, the basis begins again with the leading vectors
        kept = vectors if vectors.shape[1] + fresh.shape[1] <= most else vectors[:, :components + SPARE]
        basis = np.linalg.qr(np.column_stack([kept, fresh])[:, :width])[0]
    return np.maximum(values[:components], 0.0), vectors[:, :components], trace


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of rows with vec_id and embedding."""
    out = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")
    tiled = tiles(rows.select("vec_id", F.lit(None).cast("long").alias("label"), "embedding"), SCALE, "vectors")
    n, width = shape(tiled)
    if not n or not width:
        return rows.sparkSession.createDataFrame([], out)
    components = min(components, width)
    spectrum = combined(spectra(tiled, width, max(RANK, components + SPARE)))
    sums = dimension_sums(tiled, width)
    mean = np.array([s / n for s in sums])
    lead = spectrum.vectors[:, ::-1][:, :components + SPARE]
    if lead.shape[1] < components:  # fewer directions than components: any others complete the basis
        lead = np.column_stack([lead, np.eye(width)])
    basis = np.linalg.qr(lead)[0][:, :min(components + SPARE, width)]
    values, vectors, trace = refined(tiled, basis, mean, n, components)
    some = values > 64 * EPS * width * max(values[0], 0.0)
    scale = np.where(some, 1 / np.sqrt(np.where(some, values, 1.0)), np.nan)
    explained = [float(v) / trace if s else 0.0 for v, s in zip(values, some)] if trace > 0 else [None] * components
    whole_sums = np.array(sums, dtype=object)

    def whitened_of(tile: dict) -> np.ndarray:
        return (matrix(tile, width) - mean) @ (vectors * scale)

    def outer(tile: dict) -> np.ndarray:
        w = whitened_of(tile)[:, some]
        return w.T @ w

    error = None
    if some.any():
        covariance = (_summed(tiled, outer) / n).reshape(int(some.sum()), -1)
        error = float(np.abs(covariance - np.eye(len(covariance))).max())

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile in batch.to_pylist():
                x = matrix(tile, width)
                away = n * x.astype(object) - whole_sums if n * float(np.abs(x).max(initial=0)) > 2**62 else \
                    n * x - whole_sums.astype(np.int64)
                rough = (away.astype(float)**2).sum(1).max(initial=0)
                squares = (away * away).sum(1) if rough < 2**62 else [
                    v if v < 2**63 else None for v in (away.astype(object)**2).sum(1)]
                w, k = whitened_of(tile), len(x)
                yield pa.RecordBatch.from_arrays([
                    pa.array([i for i in tile["ids"] for _ in range(components)], pa.int64()),
                    pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), k)),
                    pa.array(np.full(k * components, n)),
                    pa.array([s for s in squares for _ in range(components)], pa.int64()),
                    pa.array(w.ravel(), from_pandas=True),
                    pa.array(explained * k, pa.float64()),
                    pa.array([error] * (k * components), pa.float64()),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return tiled.mapInArrow(emit, out)
