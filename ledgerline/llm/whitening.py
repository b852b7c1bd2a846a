"""Embedding whitening by a block Jacobi-Davidson method on distributed products.

Vectors become whole numbers x = floor(256 * c). The fit list is each distinct x once,
written as packed blocks to the shared folder. The covariance is never formed: a product
with some vectors is a Spark job in which each task centres its blocks, multiplies them
by the vectors and back, and sends on one row for each dimension, summed by a shuffle.

The driver holds only vectors of the subspace (dimensions x ``MOST`` numbers). Each outer
step takes Ritz pairs from the subspace, locks those whose residual is at double
precision, and widens the subspace by the solutions of the correction equations
(I - QQ')(V - t)(I - QQ') z = -r, with Q the locked and the present vectors. MINRES
solves them for several Ritz vectors in step, so that one job serves them all. The
subspace shrinks to its leading Ritz vectors when it is full.

Defined results: rows whose vector is null, or has a null or non-finite entry, are left
out. A shorter vector counts as one that ends in zeros, an empty one as zeros. Repeated
rows get equal results; a null vec_id stays. Components without variance (all vectors
equal, or fewer dimensions than components) are left out, so an empty table, or one with
a single distinct vector, gives no rows. Entries beyond 2**32 raise a ValueError;
a deviation that no bigint holds is null.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import output, read, schema_of, stored
from ledgerline.llm.vectors import pack, padded, sound_rows, unpack, whole

#: Vectors that the subspace holds at most, and after it has shrunk (a component).
MOST, SHRUNK = 64, 4
#: Ritz vectors that an outer step corrects, for each wanted component: a product with
#: more vectors costs hardly more, as the job reads the same blocks.
CORRECTED = 3
#: Steps of MINRES in one outer step, and how far it reduces a residual.
INNER, REDUCE = 6, 0.02
#: A residual at double precision, as a part of the largest Ritz value.
PRECISION = 2e-14
#: Vectors in one packed block of the fit list.
BLOCK = 4_096

Product = Callable[[np.ndarray], np.ndarray]


def minres(product: Product, b: np.ndarray, steps: int, reduce: float) -> np.ndarray:
    """Approximate solutions of A z = b for each column of ``b``; ``product`` gives
    A_j z_j for all columns j at once, each A_j symmetric."""
    z = np.zeros_like(b)
    v_old, v = np.zeros_like(b), b.copy()
    beta = np.linalg.norm(b, axis=0)
    start = beta.copy()
    w_old, w = np.zeros_like(b), np.zeros_like(b)
    c_old = c = np.ones(b.shape[1])
    s_old = s = np.zeros(b.shape[1])
    eta = beta.copy()
    v = v / np.where(beta > 0, beta, 1)
    for _ in range(steps):
        live = np.abs(eta) > reduce * start
        if not live.any():
            break
        p = product(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta_of(beta, v_old) * v_old
        beta_new = np.linalg.norm(p, axis=0)
        # Givens rotations turn the tridiagonal matrix into a triangular one.
        d = c * alpha - c_old * s * beta_of(beta, v_old)
        r1 = np.hypot(d, beta_new)
        r2 = s * alpha + c_old * c * beta_of(beta, v_old)
        r3 = s_old * beta_of(beta, v_old)
        r1 = np.where(r1 > 0, r1, 1)
        c_old, s_old, c, s = c, s, d / r1, beta_new / r1
        w_old, w = w, (v - r3 * w_old - r2 * w) / r1
        z = z + np.where(live, c * eta, 0) * w
        eta = np.where(live, -s * eta, eta)
        v_old, v, beta = v, p / np.where(beta_new > 0, beta_new, 1), beta_new
    return z


def beta_of(beta: np.ndarray, v_old: np.ndarray) -> np.ndarray:
    """The off-diagonal entry that belongs to ``v_old``: none in the first step."""
    return np.where((v_old != 0).any(axis=0), beta, 0)


def orthonormal(fresh: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The columns of ``fresh`` that are new to ``basis``, orthonormal to it and each other."""
    out = basis
    for column in fresh.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        column = column / size
        for _ in range(3):
            column = column - out @ (out.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
        else:
            out = np.column_stack([out, column])
    return out[:, basis.shape[1] :]


def jacobi_davidson(product: Product, size: int, wanted: int, precision: float = PRECISION, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors of a symmetric
    positive semi-definite operator on vectors of ``size`` numbers. Eigenvalues that are
    zero to double precision are left out."""
    wanted = min(wanted, size)
    room = min(size, max(MOST, 8 * wanted))
    basis = orthonormal(np.random.default_rng(11).standard_normal((size, min(size, CORRECTED * wanted))), np.zeros((size, 0)))
    image = product(basis)
    locked, values = np.zeros((size, 0)), np.zeros(0)
    best, stale = math.inf, 0
    for _ in range(rounds):
        theta, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        top = max([0.0, *theta[:1], *values[:1]])
        if not top > 0:
            break
        ritz, ritz_image = basis @ turn, image @ turn
        # Lock what has converged, largest first; the rest of the subspace is orthogonal to it.
        done = 0
        open_ = min(wanted - values.size, theta.size)
        residual = ritz_image - ritz * theta
        residual -= locked @ (locked.T @ residual)
        left = np.linalg.norm(residual[:, :open_], axis=0)
        whole_space = basis.shape[1] + locked.shape[1] >= size
        worst = float(left.max()) if left.size else 0.0
        best, stale = (worst, 0) if worst < 0.5 * best else (best, stale + 1)
        # Rounding in the sums can hold a residual just above the limit: it then no longer falls.
        limit = precision * top if stale < 4 else max(precision * top, min(best * 2, 1e-11 * top))
        while done < open_ and (left[done] <= limit or whole_space):
            done += 1
        if done:
            locked, values = np.column_stack([locked, ritz[:, :done]]), np.append(values, theta[:done])
            best, stale = math.inf, 0
        if values.size >= wanted or basis.shape[1] == done:
            break
        keep = slice(done, None)
        if room < size and basis.shape[1] - done > room - CORRECTED * wanted:
            keep = slice(done, done + SHRUNK * (wanted - values.size))
        basis, image = ritz[:, keep], ritz_image[:, keep]
        chosen = slice(done, min(CORRECTED * wanted, basis.shape[1] + done))
        target, shift, r = ritz[:, chosen], theta[chosen], residual[:, chosen]

        def project(z: np.ndarray, target=target) -> np.ndarray:
            z = z - locked @ (locked.T @ z)
            return z - target @ (target.T @ z)

        fresh = minres(lambda z: project(product(project(z)) - shift * z), -project(r), INNER, REDUCE) if r.size else np.zeros((size, 0))
        fresh = orthonormal(project(fresh), np.column_stack([locked, basis]))
        if not fresh.shape[1]:
            fresh = orthonormal(r, np.column_stack([locked, basis]))
        if not fresh.shape[1]:
            if stale > 8:
                locked, values = np.column_stack([locked, target[:, : open_ - done]]), np.append(values, shift[: open_ - done])
                break
            continue
        basis, image = np.column_stack([basis, fresh]), np.column_stack([image, product(fresh)])
    else:
        raise ArithmeticError("the eigenvectors did not reach double precision")
    real = values > 1e-13 * values[:1].sum() if values.size else np.zeros(0, bool)
    order = np.argsort(-values[real], kind="stable")
    return values[real][order], locked[:, real][:, order]


@dataclass
class Whitener:
    """What is learned from the fit list: ``size`` vectors, sums, axes and their scales."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def fit_list(vectors: DataFrame, column: str) -> DataFrame:
    """(width, n, vectors): blocks of the distinct whole-number vectors of a column."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, entries, sizes = sound_rows(batch, column)
            x = whole(entries)
            stops = np.cumsum(sizes)
            # Without zeros at the end, so that equal vectors are equal bytes.
            codes = [pack(np.trim_zeros(x[a:b], "b")) for a, b in zip((stops - sizes).tolist(), stops.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary())], ["code"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                rows = [unpack(b) for b in batch.column("code").slice(a, BLOCK).to_pylist()]
                sizes = np.array([r.size for r in rows])
                block = padded(np.concatenate(rows), sizes, width := int(sizes.max()))
                yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([len(rows)], pa.int32()), pa.array([pack(block)], pa.binary())], ["width", "n", "vectors"])

    distinct = vectors.select(column).mapInArrow(encode, "code binary").distinct()
    return stored(distinct.mapInArrow(gather, "width int, n int, vectors binary"))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for n, own, blob in zip(*(batch.column(c).to_pylist() for c in ("n", "width", "vectors")), strict=True):
            rows = unpack(blob).reshape(n, own)
            yield rows if own == width else np.concatenate([rows, np.zeros((n, width - own), np.int64)], axis=1)


def _summed(blocks: DataFrame, width: int, columns: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of ``part(block)``, a table of as many rows as it has and
    ``columns`` columns. Tasks add up their blocks first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(batches, width):
            made = part(block)
            total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.shape[0])), *(pa.array(np.ascontiguousarray(c)) for c in total.T)], ["at", *names])

    names = [f"c{i}" for i in range(columns)]
    kind = "decimal(38,0)" if part is _row_sums else "double"
    sums = blocks.mapInArrow(add, "at bigint, " + ", ".join(f"{c} {'bigint' if part is _row_sums else 'double'}" for c in names))
    table = sums.groupBy("at").agg(*(F.sum(F.col(c).cast(kind)).alias(c) for c in names)).toArrow().sort_by("at")
    return np.column_stack([np.array(table.column(c).to_pylist(), dtype=object if part is _row_sums else float) for c in names])


def _row_sums(block: np.ndarray) -> np.ndarray:
    return block.sum(axis=0)[:, None]


def fit(vectors: DataFrame, column: str, components: int = 4) -> Whitener | None:
    """The leading axes of the covariance of the distinct vectors; None without any vector."""
    blocks = fit_list(vectors, column)
    n, width = blocks.agg(F.sum("n"), F.max("width")).first()
    if not n or not width:
        return None
    sums = [int(s) for s in _summed(blocks, width, 1, _row_sums)[:, 0]]
    mean = np.array([s / n for s in sums])
    trace = float(_summed(blocks, width, 1, lambda block: ((block - mean) ** 2).sum(axis=0)[:, None]).sum()) / n

    def product(q: np.ndarray) -> np.ndarray:
        q = np.ascontiguousarray(q)

        def part(block: np.ndarray) -> np.ndarray:
            centred = block - mean
            return centred.T @ (centred @ q)

        return _summed(blocks, width, q.shape[1], part) / n

    scale = max(1.0, float(np.abs(mean).max())) ** 2
    if trace <= 1e-20 * scale * width:
        return Whitener(n, sums, np.zeros(0), np.zeros((width, 0)), trace, 0.0)
    values, axes = jacobi_davidson(product, width, components)
    white = axes / np.sqrt(values)
    found = _summed(blocks, width, values.size, lambda block: _gram((block - mean) @ white)) / n
    return Whitener(n, sums, values, axes, trace, float(np.abs(found - np.eye(values.size)).max()))


def _gram(rows: np.ndarray) -> np.ndarray:
    return rows.T @ rows


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """sum((n * x - sums)**2) of each row, exactly; null where no 64-bit integer holds it."""
    top = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if top**2 * max(1, x.shape[1]) < 2**63:
        return pa.array(((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1))
    exact = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return pa.array([e if e < 2**63 else None for e in exact], pa.int64())


def transform(vectors: DataFrame, column: str, model: Whitener, keep: list[str]) -> DataFrame:
    """``keep`` columns, deviation and the whitened coordinates of each sound row."""
    width, mean, n, sums = len(model.sums), model.mean, model.n, model.sums
    white = model.axes / np.sqrt(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, entries, sizes = sound_rows(batch, column)
            sound = batch.take(pa.array(rows))
            x = whole(entries)
            if sizes.size and sizes.max() > width:  # zeros beyond the fit list's width
                inside = np.arange(x.size) - np.repeat(np.cumsum(sizes) - sizes, sizes) < width
                x, sizes = x[inside], np.minimum(sizes, width)
            x = padded(x, sizes, width)
            made = ((x - mean) @ white).ravel()
            starts = np.arange(0, made.size + 1, max(1, white.shape[1]), dtype=np.int32) if white.shape[1] else np.zeros(rows.size + 1, np.int32)
            yield output(sound, keep, 0, rows.size, [deviations(x, n, sums), pa.ListArray.from_arrays(pa.array(starts), pa.array(made))], ["deviation", "whitened"])

    return vectors.select(*keep, column).mapInArrow(project, schema_of(vectors, keep) + "deviation bigint, whitened array<double>")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every sound embedding on the four leading components."""
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    model = fit(vectors, "embedding")
    if model is None:
        model = Whitener(1, [], np.zeros(0), np.zeros((0, 0)), 1.0, 0.0)
    explained = F.array(*(F.lit(float(v / model.trace)) for v in model.values)) if model.values.size else F.array().cast("array<double>")
    rows = transform(vectors, "embedding", model, ["vec_id"]).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
