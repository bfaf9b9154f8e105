"""Whitening of embeddings: the leading eigenvectors of their covariance by Jacobi-Davidson.

The covariance is never formed. Its product with a block of vectors is a Spark job: every task multiplies its centred rows with the block and back, partial sums meet in a tree of
bounded fan-in. On the driver lie only blocks of d-dimensional vectors. Each round extracts Ritz pairs from the subspace (Rayleigh-Ritz), locks those whose residual has reached
double precision, solves the projected correction equation of the others by a few steps of MINRES (one distributed product a step for all of
them), and extends the subspace by the corrections; a subspace that has grown too large restarts from its best Ritz vectors.

Sums of the integer components are exact, and rows are centred before anything is multiplied, so a large common offset costs no precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from layerloom.llm import vectors as V
from layerloom.llm.common import written

COMPONENTS = 32
GUARD = 8  # vectors sought beyond the wanted ones, so that the last of these is well separated
SCALE, OFFSET = 64, 1_000_000
INNER = 6  # steps of MINRES per round
ROUNDS = 200
FAN_IN = 32  # partial sums added up by one task
TOLERANCE = 500 * np.finfo(float).eps  # of a residual, relative to the largest eigenvalue
FLAT = 64 * np.finfo(float).eps  # eigenvalues below this share of the trace (times d) are rounding of zero
LARGEST = 2**62

Product = Callable[[np.ndarray], np.ndarray]


def _orthonormal(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Unit columns that span what ``block`` adds to the orthonormal ``basis``; directions that are not new are left out."""
    kept: list[np.ndarray] = []
    for column in block.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        v = column / size
        for _ in range(3):
            v = v - basis @ (basis.T @ v)
            for u in kept:
                v = v - u * (u @ v)
            size = np.linalg.norm(v)
            if size < 1e-10:
                break
            v = v / size
        else:
            kept.append(v)
    return np.array(kept).T if kept else np.zeros((len(block), 0))


def minres(product: Product, right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of symmetric systems, one for each column, all advanced together: Lanczos with Givens rotations."""
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    live = beta > 0
    v_old, v = np.zeros_like(right), np.where(live, right / np.where(live, beta, 1), 0)
    w_old, w = np.zeros_like(right), np.zeros_like(right)
    eta, beta = beta.copy(), np.zeros_like(beta)
    c_old, c, s_old, s = np.ones_like(eta), np.ones_like(eta), np.zeros_like(eta), np.zeros_like(eta)
    for _ in range(steps):
        p = product(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        following = np.linalg.norm(p, axis=0)
        low = c * alpha - c_old * s * beta
        top = np.hypot(low, following)
        mid, high = s * alpha + c_old * c * beta, s_old * beta
        usable = live & (top > 1e-300)
        top = np.where(usable, top, 1)
        c_old, s_old = c, s
        c, s = low / top, following / top
        w_old, w = w, (v - mid * w - high * w_old) / top
        x = x + np.where(usable, c * eta * w, 0)
        eta = -s * eta
        live = usable & (following > 1e-14 * np.abs(alpha) + 1e-300)
        v_old, v = v, np.where(live, p / np.where(live, following, 1), 0)
        beta = following
    return x


def jacobi_davidson(product: Product, size: int, wanted: int, inner: int = INNER, rounds: int = ROUNDS, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns, residuals) of the ``wanted`` largest of a symmetric positive semidefinite operator on ``size`` dimensions."""
    wanted = min(wanted, size)
    block = min(size, wanted + GUARD)
    most = min(size, 3 * block)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, block)))[0]
    image = product(basis)
    for _ in range(rounds):
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values, kind="stable")[:block]
        values, turn = values[order], turn[:, order]
        ritz, pushed = basis @ turn, image @ turn
        residual = pushed - ritz * values
        norms = np.linalg.norm(residual, axis=0)
        locked = norms <= TOLERANCE * max(values[0], 0)
        if locked[:wanted].all():
            return values[:wanted], ritz[:, :wanted], norms[:wanted]
        if basis.shape[1] + block > most and basis.shape[1] < size:
            basis, image = ritz, pushed
        open_ = np.flatnonzero(~locked)
        shift, own = values[open_], ritz[:, open_]
        fixed = ritz[:, locked]

        def projected(t: np.ndarray) -> np.ndarray:
            t = t - fixed @ (fixed.T @ t)
            return t - own * (own * t).sum(axis=0)

        right = -projected(residual[:, open_])
        correction = minres(lambda t: projected(product(projected(t)) - shift * projected(t)), right, inner)
        added = _orthonormal(projected(correction), basis)
        if added.shape[1] < min(len(open_), size - basis.shape[1]):  # a correction that is nothing new: the residual itself
            added = np.c_[added, _orthonormal(residual[:, open_], np.c_[basis, added])]
        if not added.shape[1]:  # nothing new at all: the subspace is computed afresh
            basis = np.linalg.qr(ritz)[0]
            image = product(basis)
            continue
        added = added[:, : size - basis.shape[1]]
        basis, image = np.c_[basis, added], np.c_[image, product(added)]
    raise RuntimeError(f"the residuals stayed at {norms[:wanted].max():g} of {values[0]:g} after {rounds} rounds")


@dataclass(frozen=True)
class Centre:
    """Sums of integer vectors, and rows minus their mean: (n x - S) / n, where n x - S is exact."""

    n: int
    sums: list[int]  # one per dimension
    stored: np.dtype
    exact_in_long: bool

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n x - S of every component, exact: as longs, or as Python's integers where these are too small."""
        kind = np.int64 if self.exact_in_long else object
        return self.n * x.astype(kind) - np.array(self.sums, dtype=kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.differences(x).astype(float) / self.n

    def unpacked(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, self.stored).reshape(-1, len(self.sums))


class CentredRows:
    """A table of integer vectors, stored in blocks."""

    def __init__(self, rows: DataFrame, size: int):
        top = rows.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(F.floor(x * SCALE).cast("double")))))).first()[0] or 0
        if top >= LARGEST:
            raise ValueError(f"a component of {top:g} / {SCALE} does not fit a long")
        stored = next(np.dtype(t) for t in ("<i2", "<i4", "<i8") if top <= np.iinfo(t).max - 1)

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                x = integers(batch.v, size).astype(stored)
                sums = x.astype(object if stored.itemsize == 8 else np.int64).sum(axis=0)
                yield pd.DataFrame({"n": [len(x)], "packed": [x.tobytes()], "sums": [[str(s) for s in sums]]})

        self.blocks = written(rows.select("v").mapInPandas(pack, "n long, packed binary, sums array<string>"), "whitening-rows")
        n, last = self.blocks.select("n", F.spark_partition_id().alias("part")).agg(F.sum("n"), F.max("part")).first()
        self.parts = last + 1
        totals = self.blocks.select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
        self.centre = Centre(n, [int(r.s) for r in sorted(totals, key=lambda r: r.at)], stored, 2 * n * top < LARGEST)

    def total(self, share: Callable[[np.ndarray], np.ndarray], length: int) -> np.ndarray:
        """The sum of ``share`` of the blocks of centred rows: a Spark job. Partial sums are added in the order of the parts, ``FAN_IN`` by a task."""

        centre = self.centre

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            found = None
            for batch in batches:
                for data in batch.packed:
                    own = np.ravel(share(centre.centred(centre.unpacked(data))))
                    found = own if found is None else found + own
            if found is not None:
                yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "sums": [found.tobytes()]})

        def add(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("part", kind="stable")
            return pd.DataFrame({"part": [rows.part.iloc[0] // FAN_IN], "sums": [np.sum([np.frombuffer(s) for s in rows.sums], axis=0).tobytes()]})

        partial, parts = self.blocks.select("packed").mapInPandas(run, "part long, sums binary"), self.parts
        while parts > FAN_IN:
            partial = partial.groupBy(F.floor(F.col("part") / FAN_IN).alias("group")).applyInPandas(add, "part long, sums binary")
            parts = -(-parts // FAN_IN)
        rows = sorted(partial.collect(), key=lambda r: r.part)
        return np.sum([np.frombuffer(r.sums) for r in rows], axis=0) if rows else np.zeros(length)

    def covariance_times(self, block: np.ndarray) -> np.ndarray:
        flat = self.total(lambda y: y.T @ (y @ block), block.size)
        return flat.reshape(block.shape) / self.centre.n


def integers(arrays, size: int) -> np.ndarray:
    """floor(64 c) of every component, as doubles; shorter vectors are padded with zeros."""
    return np.floor(SCALE * V.matrix(arrays, size))


def whiten(table: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    A component c counts as the integer floor(64 c) + 1,000,000. ``deviation`` is the sum over dimensions of (n x - S)^2, exact; it is null where it does
    not fit a long. ``identity_error`` is measured: the largest entry of the whitened rows' covariance minus the identity, from one more pass.

    Defined results: rows whose vector is null, empty or holds null or non-finite entries are left out. Rows are rows, whatever their ids (equal, null). Shorter vectors
    count as padded with zeros. Directions without variance (fewer rows or dimensions than components, equal rows) are no components, so a
    single row gives none. Equal eigenvalues have any orthonormal vectors of their space, the same for all rows. An empty table gives no rows. A component
    whose integer does not fit a long is an error. Other columns are not read.
    """
    spark = table.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = table.where(V.usable(vector_column) & (F.size(vector_column) > 0))
    rows = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    size = V.longest(rows, "v")
    if not size:
        return spark.createDataFrame([], schema)
    stored = CentredRows(rows, size)
    centre, n = stored.centre, stored.centre.n
    trace = float(stored.total(lambda y: (y * y).sum(), 1)[0]) / n
    if not trace > 0:
        return spark.createDataFrame([], schema)
    values, vectors, _ = jacobi_davidson(stored.covariance_times, size, components)
    real = values > FLAT * size * trace
    values, vectors = values[real], vectors[:, real]
    turn = vectors / np.sqrt(values)
    k = len(values)

    def gram(y: np.ndarray) -> np.ndarray:
        z = y @ turn
        return z.T @ z

    # the whitened rows' mean is 0 by construction: sums of n x - S vanish exactly
    error = float(np.abs(stored.total(gram, k * k).reshape(k, k) / n - np.eye(k)).max())
    explained, names = values / trace, np.arange(1, k + 1, dtype=np.int32)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = integers(batch.v, size).astype(centre.stored)
            apart = centre.differences(x)
            exact = centre.exact_in_long and float(np.abs(apart).max(initial=0)) ** 2 * size < LARGEST
            wide = apart if exact else apart.astype(object)
            deviation = [int(d) if d < 2**63 else None for d in (wide * wide).sum(axis=1)]
            white = centre.centred(x) @ turn
            out = {
                "vec_id": pd.array(batch.vec_id, dtype="Int64").repeat(k),
                "component": np.tile(names, len(x)),
                "n": np.int64(n),
                "deviation": pd.array(deviation, dtype="Int64").repeat(k),
                "whitened": white.ravel(),
                "explained": np.tile(explained, len(x)),
                "identity_error": error,
            }
            yield pd.DataFrame(out)

    return rows.mapInPandas(project, schema)
