"""Whitening of embeddings: principal axes by Golub-Kahan-Lanczos bidiagonalisation over distributed rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revrecon.llm.common import settle, table

#: Whole steps that a component's unit is cut into, and components that are returned.
STEPS, COMPONENTS = 64, 32
#: Entries of a block of rows, and the size beyond which entries count as that large.
BLOCK, FAR = 1 << 18, 1 << 62
#: A residual or a norm below this share of the largest singular value is rounding.
ROUNDING = 4 * np.finfo(float).eps
_SEED = 20


def whole_rows(vector: Column) -> Column:
    """True for vectors that take part: not null, and without null or non-finite entries."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def blocks_of(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Blocks of rows (ids, x: the entries floor(64 * c) as little-endian longs) where the rows lie, and the common width.

    The offset that the contract adds to every entry leaves all differences from the mean as they are, so blocks hold
    none. Shorter vectors count as padded with zeros.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(whole_rows(F.col("v")))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 1
    most = max(1, BLOCK // width)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, most):
                part = batch.slice(lo, most)
                v, n = part.column("v"), part.num_rows
                at = np.asarray(v.offsets)
                flat, size = np.asarray(v.values)[at[0] : at[-1]], np.diff(at)
                full = np.zeros((n, width))
                full[np.arange(width) < size[:, None]] = flat
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(full * STEPS), -FAR, FAR).astype("<i8")
                ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column("vec_id"))
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary())], names=["ids", "x"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return settle(rows.mapInArrow(work, f"ids array<{kind}>, x binary"), "whitening-rows"), width


def differences(data: bytes, width: int, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S for the rows of a block, exact: longs where they suffice, else Python's integers."""
    x = np.frombuffer(data, "<i8").reshape(-1, width)
    largest = int(np.abs(x).max(initial=0))
    if n * largest + max(map(abs, sums), default=0) < FAR:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squares(differences: np.ndarray) -> np.ndarray:
    """Sum of squares of each row, exact."""
    if differences.dtype != object and int(np.abs(differences).max(initial=0)) ** 2 * differences.shape[1] < FAR:
        return (differences * differences).sum(axis=1)
    wide = differences.astype(object)
    return (wide * wide).sum(axis=1)


def totals(blocks: DataFrame, width: int) -> tuple[int, list[int], list[int]]:
    """Number of rows, and per dimension the sum of the entries and of their squares, exact."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s, q = 0, [0] * width, [0] * width
        for pdf in batches:
            for data in pdf["x"]:
                x = np.frombuffer(data, "<i8").reshape(-1, width)
                if int(np.abs(x).max(initial=0)) ** 2 * len(x) >= FAR:
                    x = x.astype(object)
                n += len(x)
                s = [a + int(b) for a, b in zip(s, x.sum(axis=0), strict=True)]
                q = [a + int(b) for a, b in zip(q, (x * x).sum(axis=0), strict=True)]
        yield pd.DataFrame({"k": range(width + 1), "s": [str(v) for v in (n, *s)], "q": [str(v) for v in (0, *q)]})

    parts = blocks.select("x").mapInPandas(work, "k int, s string, q string")
    whole = "decimal(38,0)"
    rows = parts.groupBy("k").agg(F.sum(F.col("s").cast(whole)).alias("s"), F.sum(F.col("q").cast(whole)).alias("q")).collect()
    found = {r.k: (int(r.s), int(r.q)) for r in rows}
    if not found:
        return 0, [0] * width, [0] * width
    return found[0][0], [found[k][0] for k in range(1, width + 1)], [found[k][1] for k in range(1, width + 1)]


def added_up(blocks: DataFrame, width: int, n: int, sums: list[int], of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of ``of(centred rows)``, an array of one fixed size: added up in every task, then by place."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            for data in pdf["x"]:
                part = of((differences(data, width, n, sums) / n).astype(np.float64))
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"k": range(len(total)), "value": total})

    parts = blocks.select("x").mapInPandas(work, "k int, value double")
    rows = parts.groupBy("k").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(rows))
    for r in rows:
        out[r.k] = r.value
    return out


def _away_from(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``v`` without its part in the span of ``basis``; taken off twice, which leaves only rounding."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def _any_other(basis: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A unit vector at right angles to the columns of ``basis``."""
    v = _away_from(rng.normal(size=len(basis)), basis)
    return v / np.linalg.norm(v)


def bidiagonalise(product: Callable[[np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]], width: int, count: int, size: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest singular values of the centred rows Z and their right singular vectors, as columns.

    Step j of Golub, Kahan and Lanczos needs u = Z v_j - beta u_(j-1) and Z^T u. Every u is Z p for a short vector p, so
    the long vectors are never kept: ``product(P, q)`` makes r = Z q and all former u = Z P anew, block by block, and
    returns r.r, (Z P)^T r and Z^T r from one pass. With these r is made orthogonal to all former u; where that took
    away most of it, a second pass does so again. The v are orthogonalised twice here. It ends when the residuals of
    all wanted triplets are rounding, or the space is exhausted. Where a beta vanishes, the search goes on with a new
    vector at right angles to all v: so equal singular values are found as often as they occur; if Z takes that vector
    to nothing, all further singular values are zero. ``size`` is the Frobenius norm of Z.
    """
    rng, tiny = np.random.default_rng(_SEED), ROUNDING * size
    v = rng.normal(size=width)
    vs, ps, gs = (np.zeros((width, 0)) for _ in range(3))
    vs = (v / np.linalg.norm(v))[:, None]
    alphas, betas, fresh = [], [], False
    while True:
        v, before = vs[:, -1], betas[-1] if betas else 0.0
        q = v - before * ps[:, -1] if before else v
        square, along, g = product(ps, q)
        q, g = q - ps @ along, g - gs @ along
        left = max(0.0, square - along @ along)
        if 0 < left < 0.5 * square:
            square, along, g = product(ps, q)
            q, g = q - ps @ along, g - gs @ along
            left = max(0.0, square - along @ along)
        alpha = float(np.sqrt(left))
        if alpha <= tiny:
            alphas.append(0.0)
            if fresh:
                break
            p, g = np.zeros(width), np.zeros(width)
        else:
            alphas.append(alpha)
            p, g = q / alpha, g / alpha
        ps, gs = np.column_stack([ps, p]), np.column_stack([gs, g])
        t = _away_from(g - alphas[-1] * v, vs)
        beta, fresh = float(np.linalg.norm(t)), False
        if len(alphas) == width:
            break
        if beta <= tiny:
            beta, fresh, t = 0.0, True, _any_other(vs, rng)
        elif len(alphas) >= count:
            left_side, sigma, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
            if beta * np.abs(left_side[-1, :count]).max() <= ROUNDING * sigma[0]:
                break
        betas.append(beta)
        vs = np.column_stack([vs, t / np.linalg.norm(t)])
    steps = len(alphas)
    _, sigma, right = np.linalg.svd(np.diag(alphas) + np.diag(betas[: steps - 1], 1))
    axes = vs[:, :steps] @ right.T
    while axes.shape[1] < count:
        axes = np.column_stack([axes, _any_other(axes, rng)])
    return np.pad(sigma, (0, max(0, count - len(sigma))))[:count], axes[:, :count]


@dataclass(frozen=True)
class Whitening:
    """What a fit knows: rows, entry sums, axes as columns, their variances (0 where nothing varies), shares and the check."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    explained: list[float | None]
    identity_error: float | None

    @property
    def live(self) -> np.ndarray:
        return self.variances > 0


def fit(blocks: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """Principal axes of all rows of the blocks, by falling variance, and how far whitened rows are from unit covariance."""
    n, sums, squared = totals(blocks, width)
    count = min(components, width)
    spread = sum((n * q - s * s for s, q in zip(sums, squared, strict=True)), 0)
    trace = float(Fraction(spread, n * n)) if n else 0.0
    if not spread:
        return Whitening(n, sums, np.eye(width)[:, :count], np.zeros(count), [None] * count, None)

    def product(ps: np.ndarray, q: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def of(z: np.ndarray) -> np.ndarray:
            r = z @ q
            return np.concatenate([[r @ r], (z @ ps).T @ r, z.T @ r])

        found = added_up(blocks, width, n, sums, of)
        return float(found[0]), found[1 : 1 + ps.shape[1]], found[1 + ps.shape[1] :]

    sigma, axes = bidiagonalise(product, width, count, float(np.sqrt(trace * n)))
    variances = np.where(sigma > ROUNDING * width * sigma[0], sigma**2 / n, 0.0)
    scaled = axes[:, variances > 0] / np.sqrt(variances[variances > 0])
    live = scaled.shape[1]

    def moments(z: np.ndarray) -> np.ndarray:
        w = z @ scaled
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    found = added_up(blocks, width, n, sums, moments) / n
    covariance = found[live:].reshape(live, live) - np.outer(found[:live], found[:live])
    return Whitening(n, sums, axes, variances, [float(e / trace) for e in variances], float(np.abs(covariance - np.eye(live)).max()))


def whitened_rows(blocks: DataFrame, width: int, fitted: Whitening) -> DataFrame:
    """vec_id, deviation (decimal), whitened (array of doubles, null where an axis has no variance) for every row of the blocks."""
    n, sums, live = fitted.n, fitted.sums, fitted.live
    scaled = fitted.axes[:, live] / np.sqrt(fitted.variances[live])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data in zip(batch.column("ids"), batch.column("x"), strict=True):
                d = differences(data.as_py(), width, n, sums)
                w = np.zeros((len(d), len(live)))
                w[:, live] = (d / n).astype(np.float64) @ scaled
                ends = pa.array(np.arange(len(d) + 1) * len(live), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(w.ravel(), pa.float64(), mask=np.tile(~live, len(d))))
                deviation = pa.array([str(v) for v in squares(d)], pa.string())
                yield pa.RecordBatch.from_arrays([ids.values, deviation, lists], names=["vec_id", "deviation", "whitened"])

    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    rows = blocks.mapInArrow(work, f"vec_id {kind}, deviation string, whitened array<double>")
    return rows.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening]:
    """vec_id, deviation, whitened for every vector that takes part, and the fit over all of them.

    Entries are cut to floor(64 * c), at most 2**62 in size. Vectors that are null or hold null or non-finite entries
    are left out; an empty vector takes part as zeros, as does the missing end of a shorter one. Equal rows and rows
    with equal or null vec_id count one by one. Axes without variance (beyond the rank: a single row, equal rows, fewer
    rows than components) have whitened null and explained 0, or null if nothing varies at all; identity_error covers
    the others and is null if there are none. deviation is null beyond 38 digits. An empty table gives an empty result.
    Other columns are not read.

    The rows are packed into blocks where they lie and written once; each Lanczos step is one pass over the blocks that
    adds up one short array per task. Only arrays of the vectors' width reach the driver.
    """
    blocks, width = blocks_of(vectors)
    fitted = fit(blocks, width, components)
    return whitened_rows(blocks, width, fitted), fitted


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, whitened: one row per vector and component."""
    rows, fitted = whiten(table(spark, sf_dir, "embeddings"))
    shares = F.array(*[F.lit(x).cast("double") for x in fitted.explained]).cast("array<double>")
    component = (F.col("pos") + 1).cast("int")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("pos", "whitened")).select(
        "vec_id",
        component.alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        F.get(shares, F.col("pos")).alias("explained"),
        F.lit(fitted.identity_error).cast("double").alias("identity_error"),
    )
