"""Whitening of embeddings by shifted CholeskyQR over distributed Gram matrices.

1. Entries c become whole numbers x = floor(scale * c) + lift. The fit list is each distinct x vector once; its n vectors and
   their sums S give centred rows d = (n x - S) / n, in which n x - S is exact, so that a large common part costs no digits.
2. A pass adds up the Gram matrix of Q = d inverse(R1) inverse(R2) ... block by block: each task solves with the triangular
   factors so far, and sends one small matrix. The Cholesky factor of Gram + shift is the next R. The first shift is what rounding
   may need; later ones are a few units of rounding. Passes go on until Q's Gram matrix is the identity, for three factors at least.
3. The factors' product R has R'R = d'd without the shift, so the singular values and right vectors of R / sqrt(n) are those of the
   centred rows: eigenvalues e of the covariance, and components. A row is whitened by its projections over sqrt(e).

Nothing but d x d matrices reaches the driver. Written tables are read again by every pass, so a lost executor costs its blocks only.

Defined cases: vectors that are null, empty, or hold null or non-finite entries, or entries of 2^40 / scale or more, take no part;
of vectors of several lengths those of the most frequent one (the longer one on ties) take part; null and repeated ids and repeated rows are whitened row by
row, and weigh once in the fit if their x are equal; components without variance (e below 1e-24 of the trace) are left out, so one distinct vector
gives no rows; `deviation` is null where it doesn't fit in 64 bits; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

EPS = np.finfo(float).eps
#: Entries of x below this stay exact in sums and products by n.
WIDEST = 1 << 40


def lifted(df: DataFrame, id_col: str, vector_col: str, scale: int, lift: int) -> DataFrame:
    """id, x (array<long>) of the rows that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda e: e.cast("double") * scale).alias("c")).where("c IS NOT NULL AND size(c) > 0")
    good = F.forall("c", lambda e: F.coalesce((F.abs(e) < WIDEST) & ~F.isnan(e), F.lit(False)))
    rows = keep(rows.where(good).select("id", F.transform("c", lambda e: F.floor(e).cast("long") + lift).alias("x")), "lifted")
    sizes = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).take(1)
    return rows.where(F.size("x") == (sizes[0]["width"] if sizes else 0))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches and their vectors as a matrix."""
    for batch in batches:
        if batch.num_rows:
            column = batch.column("x")
            yield batch, column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def summed(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray | None:
    """The sum over all rows of a small array that `of` makes of a block; tasks send one array each. None without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in blocks(batches):
            got = of(x)
            total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "value"])

    wide = "decimal(38,0)" if kind == "long" else kind
    cells = rows.select("x").mapInArrow(run, f"at long, value {kind}").groupBy("at").agg(F.sum(F.col("value").cast(wide)).alias("value"))
    got = sorted(tuple(r) for r in cells.collect())  # as many as the array has entries
    return np.array([int(v) if kind == "long" else v for _, v in got], object if kind == "long" else float) if got else None


def scaled_difference(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact: 64-bit integers, or Python's where those could overflow."""
    if n * (int(np.abs(x).max()) + 1) < 1 << 61:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return scaled_difference(x, n, sums).astype(float) / n


def orthogonal(d: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """d inverse(R1) inverse(R2) ..., by solves with the triangular factors."""
    for r in factors:
        d = np.linalg.solve(r.T, d.T).T
    return d


def cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """The upper factor of gram + shift, with a larger shift where it is not positive."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(100 * shift, EPS * EPS)


def triangular_factor(rows: DataFrame, n: int, sums: np.ndarray, most: int = 8) -> np.ndarray:
    """R with R'R = d'd over the centred rows."""
    factors: list[np.ndarray] = []
    width = len(sums)
    for turn in range(most):
        gram = summed(rows, lambda x, f=list(factors): (lambda q: q.T @ q)(orthogonal(centred(x, n, sums), f)), "double").reshape(width, width)
        gram = (gram + gram.T) / 2
        if turn >= 3 and np.abs(gram - np.eye(width)).max() < 1e-10:
            break
        if not factors:
            if not gram.any():
                return np.zeros((width, width))
            shift = 11 * (n * width + width * (width + 1)) * EPS / 2 * np.trace(gram)
        else:
            shift = 4 * width * EPS if np.linalg.eigvalsh(gram)[0] < 0.5 else 0.0
        factors.append(cholesky(gram, shift))
    out = np.eye(width)
    for r in factors:
        out = r @ out
    return out


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, lift: int = 1_000_000, most: int = 16) -> DataFrame:
    """Each row that takes part and component up to `most`: id, component, n, deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    schema = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = lifted(df, id_col, vector_col, scale, lift)
    fit = keep(rows.select("x").distinct(), "fit")
    n = fit.count()
    if not n:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    sums = summed(fit, lambda x: x.sum(0), "long")
    _, values, right = np.linalg.svd(triangular_factor(fit, n, sums) / np.sqrt(n))
    e = values**2
    chosen = np.flatnonzero(e[:most] > 1e-24 * e.sum())
    turn = right[chosen].T / values[chosen]
    explained = e[chosen] / e.sum() if e.any() else e[chosen]

    def cross(x: np.ndarray) -> np.ndarray:
        w = centred(x, n, sums) @ turn
        return np.vstack([w.T @ w, w.sum(0)])

    error = 0.0
    if len(chosen):
        got = summed(fit, cross, "double").reshape(-1, len(chosen))
        mean = got[-1] / n
        error = float(np.abs(got[:-1] / n - np.outer(mean, mean) - np.eye(len(chosen))).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(chosen)
        for batch, x in blocks(batches) if k else ():
            y = scaled_difference(x, n, sums)
            white = (y.astype(float) / n) @ turn
            if float(np.abs(y).max()) ** 2 * len(sums) < 2**62:
                deviation = pa.array((y * y).sum(1))
            else:
                exact = [sum(int(v) ** 2 for v in row) for row in y]
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            each = pa.array(np.repeat(np.arange(len(x)), k))
            m = len(each)
            cols = [batch.column("id").take(each), pa.array(np.tile(chosen + 1, len(x)).astype(np.int32)), pa.array(np.full(m, n)), deviation.take(each), pa.array(white.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(m, error))]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", "x").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
