"""Whitening of embeddings by a matrix-free Jacobi-Davidson eigensolver.

Vectors are put on an integer grid, each distinct grid vector counts once (the fit list), and the
covariance V of the fit list is never formed. All work on rows is one product ``X' (X Q) / n`` of the
centred fit list with a narrow block Q: tasks sum their rows in NumPy, Spark adds the tasks' sums, and
the driver holds blocks of dimension x a few columns.

The solver keeps an orthonormal subspace and its products. Each step takes the Ritz pairs of the
subspace, locks those whose residual is at double precision, solves the projected correction equation
``(I - UU')(V - t I)(I - UU') s = -r`` of the others by inner MINRES steps that share their products,
and widens the subspace by the corrections. A full subspace restarts from its best Ritz vectors.

Results for odd rows: rows whose vector is null, empty or holds null or non-finite entries are dropped,
and so are vectors of another length than the most frequent one (the smaller of equally frequent ones);
repeated vectors count once in the fit and each gets its rows; components whose variance is zero (fewer
distinct vectors or dimensions than components) are left out, so a fit list of one vector and an empty
table give no rows; kept columns named like a result are replaced by it. A deviation beyond 64 bits raises.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patio.llm.common import private
from patio.session import durable

GRID = 256
COMPONENTS = 4
#: Widest subspace, its width after a restart, inner steps and outer steps at most, and pairs that are
#: corrected beyond the wanted ones: they keep close eigenvalues apart and share the products.
SUBSPACE, RESTART, INNER, OUTER, EXTRA = 48, 16, 4, 500, 4
#: Rows of a batch that are multiplied at once.
ROWS = 4096
EPS = np.finfo(float).eps


def grid_rows(df: DataFrame, vector: str, keep: list[str], into: str, grid: int = GRID) -> DataFrame:
    """The kept columns and the finite vectors of the most frequent length as whole numbers."""
    v = F.col(f"`{vector}`").cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.filter(v.isNotNull() & (F.size(v) > 0) & fine)
    sizes = rows.groupBy(F.size(v).alias("d")).count()
    usual = sizes.orderBy(F.desc("count"), "d").limit(1).select("d").scalar()
    return rows.filter(F.size(v) == usual).select(
        *[F.col(f"`{c}`") for c in keep], F.transform(v, lambda c: F.floor(c * grid).cast("long")).alias(into))


def matrix(column: pa.Array) -> np.ndarray:
    """The lists of a batch as rows of a matrix."""
    return np.asarray(column.flatten()).reshape(len(column), -1)


class FitList:
    """Distinct grid vectors as a table, with sums over its rows."""

    def __init__(self, x: DataFrame):  # one column of vectors
        self.table = durable(x.distinct())
        head = self.table.select(F.size(x.columns[0]).alias("d")).first()
        self.d = head.d if head else 0
        self.n = self.table.count()
        self.sums = self._total(lambda m: m.sum(axis=0), self.d, T.LongType())
        self.mean = self.sums / max(self.n, 1)

    def _total(self, of_rows, size: int, kind=T.DoubleType()) -> np.ndarray:
        """Sum over the table of ``of_rows(integer rows)``, an array of ``size`` numbers. Each task gives
        one array, and the arrays are added place by place."""
        dtype = np.int64 if kind == T.LongType() else np.float64

        def run(batches):
            total = np.zeros(size, dtype)
            for batch in batches:
                m = matrix(batch.column(0))
                for at in range(0, len(m), ROWS):
                    total += of_rows(m[at:at + ROWS])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["i", "s"])

        schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("s", kind)])
        out = np.zeros(size, dtype)
        if size:
            added = self.table.mapInArrow(run, schema).groupBy("i").agg(F.sum("s").alias("s")).toArrow()
            out[np.asarray(added["i"])] = np.asarray(added["s"])
        return out

    def product(self, q: np.ndarray) -> np.ndarray:
        """The covariance times a block of columns, centred before multiplying."""
        mean = self.mean

        def of_rows(m):
            c = m - mean
            return (c.T @ (c @ q)).ravel()
        return self._total(of_rows, q.size).reshape(q.shape) / self.n

    def trace(self) -> float:
        mean = self.mean
        return float(self._total(lambda m: np.array([((m - mean) ** 2).sum()]), 1)[0]) / self.n

    def identity_error(self, directions: np.ndarray) -> float:
        """Largest absolute entry of the projected list's covariance minus the identity."""
        mean, k = self.mean, directions.shape[1]

        def of_rows(m):
            w = (m - mean) @ directions
            return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        sums = self._total(of_rows, k + k * k) / self.n
        cov = sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])
        return float(np.abs(cov - np.eye(k)).max())


def minres(apply, b: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """MINRES for several right-hand sides at once; ``apply`` works on the columns still active and
    takes their numbers. A column stops at its relative residual or when its Krylov space is used up."""
    x = np.zeros_like(b)
    beta = np.linalg.norm(b, axis=0)
    start, live = beta.copy(), np.flatnonzero(beta > 0)
    v_old, v = np.zeros_like(b), b / np.where(beta > 0, beta, 1)
    w_old, w = np.zeros_like(b), np.zeros_like(b)
    c_old, c = np.ones(b.shape[1]), np.ones(b.shape[1])
    s_old, s = np.zeros(b.shape[1]), np.zeros(b.shape[1])
    eta, beta = beta.copy(), np.zeros(b.shape[1])
    for _ in range(steps):
        if not len(live):
            break
        j = live
        av = apply(v[:, j], j)
        alpha = np.einsum("ij,ij->j", v[:, j], av)
        nxt = av - v[:, j] * alpha - v_old[:, j] * beta[j]
        beta_new = np.linalg.norm(nxt, axis=0)
        delta = c[j] * alpha - c_old[j] * s[j] * beta[j]
        r1 = np.hypot(delta, beta_new)
        r2 = s[j] * alpha + c_old[j] * c[j] * beta[j]
        r3 = s_old[j] * beta[j]
        r1 = np.where(r1 > 0, r1, 1)
        c_old[j], s_old[j] = c[j], s[j]
        c[j], s[j] = delta / r1, beta_new / r1
        direction = (v[:, j] - w_old[:, j] * r3 - w[:, j] * r2) / r1
        w_old[:, j], w[:, j] = w[:, j], direction
        x[:, j] += direction * (c[j] * eta[j])
        eta[j] = -s[j] * eta[j]
        v_old[:, j], v[:, j] = v[:, j], nxt / np.where(beta_new > 0, beta_new, 1)
        beta[j] = beta_new
        live = j[(np.abs(eta[j]) > tolerance * start[j]) & (beta_new > EPS * np.abs(alpha))]
    return x


def _widen(w: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Orthonormal columns that carry ``new`` beyond the span of ``w``; columns inside it fall away."""
    out = np.zeros((len(w), 0))
    for t in new.T:
        size = np.linalg.norm(t)
        for _ in range(3):
            t = t - w @ (w.T @ t)
            t = t - out @ (out.T @ t)
            left = np.linalg.norm(t)
            if left <= 1e-10 * size or left == 0:
                break
            t, size = t / left, 1.0
        else:
            out = np.column_stack([out, t])
    return out


def largest_eigenpairs(product, d: int, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and unit eigenvectors of a symmetric positive operator that
    is known by ``product(block)`` alone. Ends when all residuals are at double precision."""
    rng = np.random.default_rng(seed)
    k = min(k, d)
    w = np.linalg.qr(rng.standard_normal((d, min(d, k + 4))))[0]
    aw = product(w)
    for outer in range(OUTER):
        h = w.T @ aw
        values, s = np.linalg.eigh((h + h.T) / 2)
        values, s = values[::-1], s[:, ::-1]
        wide = min(k + EXTRA, w.shape[1])
        u, au = w @ s[:, :wide], aw @ s[:, :wide]
        r = au - u * values[:wide]
        exact = 32 * EPS * np.sqrt(d) * abs(values[0])
        norms = np.linalg.norm(r, axis=0)
        open_ = np.flatnonzero(norms > exact)
        if not (norms[:k] > exact).any():
            u = u[:, :k]
            au = product(u)  # the pairs stand only with fresh products
            r = au - u * values[:k]
            if (np.linalg.norm(r, axis=0) <= 2 * exact).all() or w.shape[1] == d:
                return values[:k], u
            w = np.linalg.qr(w)[0]
            aw = product(w)
            continue
        if w.shape[1] + len(open_) > SUBSPACE < d:
            w, aw = w @ s[:, :RESTART], aw @ s[:, :RESTART]
        shifts = values[:wide]

        def corrected(t, j):
            t = t - u @ (u.T @ t)
            out = product(t) - t * shifts[open_[j]]
            return out - u @ (u.T @ out)

        rhs = -(r[:, open_] - u @ (u.T @ r[:, open_]))
        t = minres(corrected, rhs, INNER, max(2.0 ** -(outer + 2), 1e-4))
        new = _widen(w, t)
        if not new.shape[1]:
            new = _widen(w, rng.standard_normal((d, 1)))
        new = new[:, :d - w.shape[1]]
        if not new.shape[1]:  # the subspace is the whole space: its pairs are exact
            w = np.linalg.qr(w)[0]
            aw = product(w)
            values, s = np.linalg.eigh(w.T @ aw)
            return values[::-1][:k], (w @ s[:, ::-1])[:, :k]
        w, aw = np.column_stack([w, new]), np.column_stack([aw, product(new)])
    raise RuntimeError(f"no convergence in {OUTER} steps; residuals {norms}")


@dataclass
class Whitening:
    """A fitted whitening; ``directions`` are eigenvectors over the root of their eigenvalue."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def directions(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fits on the distinct rows of a column of grid vectors."""
    fit = FitList(vectors)
    trace = fit.trace() if fit.d else 0.0
    values, vectors = np.zeros(0), np.zeros((fit.d, 0))
    if trace > 0:
        values, vectors = largest_eigenpairs(fit.product, fit.d, components)
        real = values > 64 * EPS * fit.d * values[0]
        values, vectors = values[real], vectors[:, real]
    model = Whitening(fit.n, fit.sums, values, vectors, trace, 0.0)
    if len(values):
        model.identity_error = fit.identity_error(model.directions)
    return model


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Exact sums over dimensions of (n x - S)^2."""
    top = float(n) * max(float(np.abs(x).max(initial=0)), 1.0) + float(np.abs(sums).max(initial=0))
    if top * top * x.shape[1] < 2 ** 62:
        return ((n * x - sums) ** 2).sum(axis=1)
    exact = ((int(n) * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)
    return exact.astype(np.int64)  # raises beyond 64 bits


def whiten(df: DataFrame, vector: str = "embedding", keep: list[str] | None = None, grid: int = GRID,
           components: int = COMPONENTS) -> DataFrame:
    """The kept columns and, per row and component, ``component``, ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``; kept columns of these names are replaced."""
    made = [("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()),
            ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType())]
    names = {name for name, _ in made} | ({vector.lower()} if keep is None else set())
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    x = private(df, "_x")
    rows = grid_rows(df, vector, kept, x, grid)
    model = fit_whitening(rows.select(x), components)
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(c, t) for c, t in made])
    k, mean, directions = len(model.values), model.sums / max(model.n, 1), model.directions
    explained = model.values / model.trace if k else model.values

    def run(batches):
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                m = matrix(part.column(len(kept)))
                rows_of = np.repeat(np.arange(len(m)), k)
                carried = [part.column(i).take(pa.array(rows_of)) for i in range(len(kept))]
                columns = [np.tile(np.arange(1, k + 1, dtype=np.int32), len(m)), np.full(len(m) * k, model.n),
                           np.repeat(deviations(m, model.n, model.sums), k), ((m - mean) @ directions).ravel(),
                           np.tile(explained, len(m)), np.full(len(m) * k, model.identity_error)]
                yield pa.RecordBatch.from_arrays([*carried, *map(pa.array, columns)], names=schema.names)

    return rows.mapInArrow(run, schema)
