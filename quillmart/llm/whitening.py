"""Operator 13: whitening of embeddings by QDWH spectral divide-and-conquer.

Vectors are turned into whole numbers, x = floor(256 c).  Each distinct vector counts
once in the fit: Spark removes repeats (combining before the shuffle), sums dimensions,
and sums the products of centred entries per pair of dimensions.  What reaches the
driver is d sums and d (d + 1) / 2 products, whatever the number of vectors.

The d x d covariance A is taken apart by polar decompositions: the polar factor U of
A - s I, found by the dynamically weighted Halley iteration, is +1 on the directions
with eigenvalues above s and -1 on those below, so (U + I) / 2 projects onto the upper
invariant subspace.  A basis of it and one of its complement split A into two smaller
blocks, each of which is split again until blocks are single directions: the components.
They are broadcast, and every row is projected and divided by the root of its
component's eigenvalue.  The covariance of the whitened fit list is measured over all
of its rows, and its distance from the identity is returned with each row.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries
are dropped, and so are vectors of another length than the commonest (of equally common
ones the longest); a null id is an id like any other; repeated rows are fitted once and
each returned; components without variance can't be whitened and are left out, so a
table of equal vectors or an empty table gives no rows; other columns are not read.  A
deviation beyond 2^63 - 1 is null.  Equal eigenvalues may have any basis of their space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import stored, table

SCALE = 256
COMPONENTS = 4
#: Eigenvalues below this share of the largest are rounding, not variance.
LEAST_SHARE = 1e-12
#: Where to split next, in standard deviations from the mean eigenvalue.
SHIFTS = (0.0, 0.3, -0.3, 0.61, -0.61, 0.13, -0.13, 0.89, -0.89)
#: Vectors that a Python task holds at once.
ROWS = 4096


# ---------------------------------------------------------------- decomposition --

def polar(a: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a symmetric matrix, by QDWH iteration."""
    n = len(a)
    x = a / max(np.linalg.norm(a, 2), np.finfo(float).tiny)
    low = np.finfo(float).eps  # a lower bound of the smallest singular value
    for _ in range(12):
        l2 = low * low
        g = np.cbrt(4 * (1 - l2) / (l2 * l2))
        wa = np.sqrt(1 + g) + 0.5 * np.sqrt(8 - 4 * g + 8 * (2 - l2) / (l2 * np.sqrt(1 + g)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
            new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            z = np.eye(n) + wc * (x.T @ x)
            new = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(z, x.T).T
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        if abs(1 - low) < 1e-14 and moved < np.cbrt(np.finfo(float).eps):
            break
    return x


def _basis(p: np.ndarray, rank: int) -> np.ndarray:
    """An orthonormal basis of the range of a projector."""
    start = np.random.default_rng(13).standard_normal((len(p), rank))
    q, _ = np.linalg.qr(p @ start)
    q, _ = np.linalg.qr(p @ q)
    return q


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of a symmetric matrix."""
    size = max(np.linalg.norm(a), np.finfo(float).tiny)
    done: list[tuple[float, np.ndarray]] = []
    blocks = [(a, np.eye(len(a)))]
    while blocks:
        block, basis = blocks.pop()
        n = len(block)
        spread = block - np.eye(n) * np.trace(block) / n
        if n == 1 or np.linalg.norm(spread) <= 4 * np.finfo(float).eps * size:
            done += [(float(v @ a @ v), v) for v in basis.T]
            continue
        # A shift that is itself an eigenvalue leaves its direction on neither side, so others follow
        # the median; some eigenvalue lies a standard deviation or more from the mean.
        mean, sd = float(np.trace(block) / n), float(np.linalg.norm(spread) / np.sqrt(n))
        for shift in (float(np.median(np.diag(block))), *(mean + t * sd for t in SHIFTS)):
            p = (polar(block - shift * np.eye(n)) + np.eye(n)) / 2
            rank = int(round(np.trace(p)))
            if 0 < rank < n and np.linalg.norm(p @ p - p) < 1e-10 * n:
                break
        else:  # equal to rounding
            done += [(float(v @ a @ v), v) for v in basis.T]
            continue
        for half, r in ((p, rank), (np.eye(n) - p, n - rank)):
            q = _basis(half, r)
            inner = q.T @ block @ q
            blocks.append(((inner + inner.T) / 2, basis @ q))
    done.sort(key=lambda e: -e[0])
    return np.array([e for e, _ in done]), np.array([v / np.linalg.norm(v) for _, v in done]).T


# ------------------------------------------------------------------------ Spark --

def whole(vector: str) -> Column:
    """The vector as whole numbers; null where it has none."""
    c = F.col(vector)
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    ints = F.transform(c, lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    return F.when(c.isNotNull() & (F.size(c) > 0) & ~bad, ints)


@dataclass
class Model:
    """What whitening needs: all of it is of the size of the dimensions, not of the rows."""
    n: int
    sums: list[int]
    largest: int
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _matrices(batches: Iterator[pa.RecordBatch], column: str = "x") -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            x = batch.slice(at, ROWS).column(column)
            if len(x):
                yield x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _products(fit: DataFrame, mean: np.ndarray, vectors: np.ndarray | None = None) -> np.ndarray:
    """Sum over the fit list of the products of centred entries (projected, if ``vectors`` are given).

    A task gives one row per pair of dimensions; Spark adds those up by pair.
    """
    d = len(mean) if vectors is None else vectors.shape[1]
    shared = fit.sparkSession.sparkContext.broadcast((mean, vectors))
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, vectors = shared.value
        total = np.zeros((d, d))
        some = False
        for x in _matrices(batches):
            y = x - mean
            y = y if vectors is None else y @ vectors
            total += y.T @ y
            some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype("int32")), pa.array(upper[1].astype("int32")), pa.array(total[upper])],
                                             ["i", "j", "v"])

    out = np.zeros((d, d))
    for r in fit.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out


def fit_list(df: DataFrame, vector: str) -> DataFrame:
    """(x): each distinct whole vector of the commonest length once, stored."""
    x = df.select(whole(vector).alias("x")).where("x IS NOT NULL").distinct()
    x = stored(x)
    lengths = x.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    best = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return x.where(F.size("x") == (best.d if best else 0))


def fit(x: DataFrame, most: int = COMPONENTS) -> Model | None:
    """The model of a fit list; None where there is nothing to whiten."""
    sums = (x.select(F.posexplode("x").alias("i", "v")).groupBy("i")
            .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n"),
                 F.max(F.abs(F.col("v").cast("decimal(20,0)"))).alias("m")).orderBy("i").collect())
    if not sums:
        return None
    model = Model(int(sums[0].n), [int(r.s) for r in sums], max(int(r.m) for r in sums), np.zeros(0), np.zeros((len(sums), 0)), 0.0)
    cov = _products(x, model.mean) / model.n
    values, vectors = components(cov)
    real = (values > LEAST_SHARE * max(values[0], 0)) & (values > 0)
    model.values, model.vectors, model.trace = values[real][:most], vectors[:, real][:, :most], float(np.trace(cov))
    if not len(model.values):
        return None
    scaled = _products(x, model.mean, model.vectors / np.sqrt(model.values)) / model.n
    model.error = float(np.abs(scaled - np.eye(len(scaled))).max())
    return model


def whiten(df: DataFrame, id_col: str, vector: str, model: Model) -> DataFrame:
    """(id, component, deviation, whitened) of every row that has a vector of the model's length."""
    d = len(model.sums)
    rows = df.select(F.col(id_col).alias("id"), whole(vector).alias("x")).where(F.size("x") == d)
    shared = df.sparkSession.sparkContext.broadcast(model)
    from pyspark.sql.pandas.types import to_arrow_type
    id_type, id_ddl = to_arrow_type(rows.schema["id"].dataType), rows.schema["id"].dataType.simpleString()
    bound = (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        sums, scaled, k = np.array(m.sums, dtype=object), m.vectors / np.sqrt(m.values), len(m.values)
        # Whole numbers fit 64 bits if the largest possible sum of squares does.
        small = d * (2 * m.n * m.largest) ** 2 <= bound
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, d)
                if small:
                    deviation = ((x * m.n - sums.astype("int64")) ** 2).sum(1).tolist()
                else:
                    deviation = [v if v <= bound else None for v in ((x.astype(object) * m.n - sums) ** 2).sum(1).tolist()]
                white = (x - m.mean) @ scaled
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(np.repeat(np.arange(part.num_rows), k))).cast(id_type),
                     pa.array(np.tile(np.arange(1, k + 1, dtype="int32"), part.num_rows)),
                     pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(part.num_rows), k))), pa.array(white.ravel())],
                    ["id", "component", "deviation", "whitened"])

    return rows.mapInArrow(run, f"id {id_ddl}, component int, deviation long, whitened double")


def op13_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every embedding."""
    rows = table(spark, sf_dir, "embeddings")
    model = fit(fit_list(rows, "embedding"))
    if model is None:
        kind = rows.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    share = F.create_map(*[v for k, e in enumerate(model.values) for v in (F.lit(k + 1), F.lit(float(e / model.trace)))])
    return whiten(rows, "vec_id", "embedding", model).select(
        F.col("id").alias("vec_id"), "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        share[F.col("component")].alias("explained"), F.lit(model.error).alias("identity_error"))
