"""Embedding whitening by QDWH spectral divide and conquer.

The fit list is each distinct integer vector x once. Spark finds it, sums it and adds up the
products of its centred vectors; the covariance V that comes to the driver has the size of a
vector, squared, whatever the number of rows. There V is split: the polar factor U of V - shift,
found by QDWH iterations, is the sign of the shifted matrix, (U + I) / 2 the projector on the
invariant subspace above the shift. Bases of this space and its complement split V into two
blocks, and so on until every block is one component. Rows are whitened with the broadcast result.

Defined results: rows whose vector is null or holds null or non-finite entries have no result;
shorter vectors count as filled up with zeros; repeated rows each get theirs and count once in the
fit; components without variance (up to rounding) are left out, so that a table with fewer than two
different vectors has none; an empty table gives no rows. A deviation that no long holds is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import scratch_released
from .pieces import free
from .scratch import settled
from .vectors import dimension, pack, unpack, whole

_EPS = np.finfo(float).eps
#: Components whose variance is below this share of the largest are rounding.
NO_VARIANCE = 1e-12
ROWS = 4096


# ---- divide and conquer on one symmetric matrix


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric, not singular matrix, by QDWH iterations.

    Raises ``LinAlgError`` for a matrix that is singular to working precision.
    """
    unit = np.eye(len(a))
    x = a / np.linalg.norm(a)
    low = 1 / np.linalg.norm(np.linalg.inv(x))
    if not low > 10 * _EPS:
        raise np.linalg.LinAlgError("singular")
    for _ in range(40):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square ** 2)
        root = np.sqrt(1 + d)
        p = root + np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0)) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        if r > 100:
            both = np.linalg.qr(np.vstack([np.sqrt(r) * x, unit]))[0]
            upper, lower = both[:len(a)], both[len(a):]
            new = q / r * x + (p - q / r) / np.sqrt(r) * upper @ lower.T
        else:
            new = q / r * x + (p - q / r) * np.linalg.solve(unit + r * x.T @ x, x.T).T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(low * (p + q * square) / (1 + r * square), 1.0)
        if moved <= np.cbrt(_EPS) * np.linalg.norm(x) and 1 - low <= 10 * _EPS:
            break
    return x


def _halves(a: np.ndarray, shift: float) -> tuple[np.ndarray, int, float]:
    """A basis whose first columns span the space above ``shift``, their number, what is left."""
    size = len(a)
    above = (polar(a - shift * np.eye(size)) + np.eye(size)) / 2
    count = round(float(np.trace(above)))
    if not 0 < count < size:
        raise np.linalg.LinAlgError("all values lie on one side")
    start = np.random.default_rng(size).standard_normal((size, count))
    near = np.linalg.qr(above @ start)[0]
    basis = np.linalg.qr(above @ near, mode="complete")[0]
    return basis, count, float(np.linalg.norm(basis[:, count:].T @ a @ basis[:, :count]))


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns.

    A shift at which the matrix does not split cleanly, such as an eigenvalue, is moved. Where
    eigenvalues are equal to working precision any basis of their space is right.
    """
    v = (v + v.T) / 2
    scale = np.linalg.norm(v)
    done, open_ = [], [(v, np.eye(len(v)))]
    while open_:
        a, basis = open_.pop()
        diagonal = np.diag(a)
        if len(a) == 1 or np.linalg.norm(a - np.diag(diagonal)) <= len(a) * _EPS * scale:
            done += [(float(diagonal[i]), basis[:, i]) for i in range(len(a))]
            continue
        low, high = diagonal.min(), diagonal.max()
        shifts = [np.median(diagonal), diagonal.mean(),
                  *(low + (high - low) * t for t in (0.381966, 0.618034, 0.25, 0.75, 0.1, 0.9))]
        best = None
        for shift in shifts:
            try:
                found = _halves(a, float(shift))
            except np.linalg.LinAlgError:
                continue
            if best is None or found[2] < best[2]:
                best = found
            if best[2] <= 10 * len(a) * _EPS * scale:
                break
        if best is None:  # all values equal up to rounding, by every shift within their range
            done += [(float(diagonal[i]), basis[:, i]) for i in range(len(a))]
            continue
        turn, count, _ = best
        a, basis = turn.T @ a @ turn, basis @ turn
        for part in (slice(0, count), slice(count, None)):
            block = a[part, part]
            open_.append(((block + block.T) / 2, basis[:, part]))
    done.sort(key=lambda pair: -pair[0])
    vectors = np.array([vector for _, vector in done]).reshape(len(v), len(v)).T
    if len(v):
        largest = vectors[np.abs(vectors).argmax(0), np.arange(len(v))]
        vectors = vectors * np.where(largest < 0, -1, 1)
    return np.array([value for value, _ in done]), vectors


# ---- the fit


@dataclass(frozen=True)
class Whitening:
    """What was fitted; ``vectors`` has the components as columns, ``sums`` are exact."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - np.array([s / self.n for s in self.sums])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S) ** 2, exact; None where a long does not hold one."""
        reach = self.n * float(np.abs(x).max(initial=0)) + max(map(abs, map(float, self.sums)),
                                                              default=0.0)
        exact = np.int64 if reach ** 2 * max(x.shape[1], 1) < 2.0 ** 62 else object
        far = x.astype(exact) * self.n - np.array(self.sums, exact)
        total = (far * far).sum(1).tolist()
        return [t if t < 2 ** 63 else None for t in total]


def _summed(vectors: DataFrame, size: int, cells: int, kind: T.DataType,
            work: Callable[[np.ndarray], np.ndarray]) -> list:
    """``cells`` numbers: the sum of ``work`` over runs of the packed vectors.

    Every task adds up its own runs; the sums of the tasks are added by Spark, cell by cell.
    """
    schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("value", kind)])
    arrow = pa.int64() if isinstance(kind, T.LongType) else pa.float64()

    def add(batches: Iterator[pa.RecordBatch]):
        total = None
        for batch in batches:
            for first in range(0, len(batch), ROWS):
                own = work(unpack(batch.column(0).slice(first, ROWS), size)).ravel()
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(cells), pa.int32()), pa.array(total, arrow)],
                names=schema.names)

    rows = vectors.mapInArrow(add, schema).groupBy("cell").agg(F.sum("value").alias("value"))
    out = [0] * cells
    for row in rows.collect():
        out[row.cell] = row.value
    return out


def _packed(df: DataFrame, vector: str, size: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            for first in range(0, len(batch), ROWS):
                rows = pack(whole(batch.column(0).slice(first, ROWS), size)[1])
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["x"])

    return df.select(F.col(f"`{vector}`").alias("v")).mapInArrow(work, "x binary")


def fit(df: DataFrame, vector: str = "embedding", keep: int | None = None) -> Whitening | None:
    """The whitening of a vector column with its first ``keep`` components (default: all).

    None if no row has a vector. The distinct vectors are written once and read three times: for
    their sums, for the products of the centred vectors, and for the covariance that whitened
    vectors really have.
    """
    spark, size = df.sparkSession, dimension(df, vector)
    with scratch_released(spark):
        distinct = settled(_packed(df, vector, size).distinct(), "vectors")
        first = _summed(distinct, size, size + 1, T.LongType(),
                        lambda x: np.append(x.sum(0), len(x)))
        if not first[size]:
            return None
        start = Whitening(first[size], tuple(first[:size]), np.zeros(0), np.zeros((size, 0)), 0.0)

        def products(x):
            centred = start.centred(x)
            return centred.T @ centred

        v = np.array(_summed(distinct, size, size * size, T.DoubleType(), products), float)
        values, vectors = components(v.reshape(size, size) / start.n)
        trace = float(values.sum())
        real = values > NO_VARIANCE * max(values.max(initial=0.0), 0.0)
        model = replace(start, values=values[real][:keep], vectors=vectors[:, real][:, :keep],
                        trace=trace)
        count = len(model.values)

        def spread(x):
            white = model.whiten(x)
            return np.vstack([white.T @ white, white.sum(0)])

        white = np.array(_summed(distinct, size, (count + 1) * count, T.DoubleType(), spread),
                         float).reshape(count + 1, count) / model.n
        found = white[:count] - np.outer(white[count], white[count])
        return replace(model, identity_error=float(np.abs(found - np.eye(count)).max(initial=0)))


def whitened(df: DataFrame, model: Whitening, vector: str = "embedding", name: str = "whitened",
             deviation: str = "deviation") -> DataFrame:
    """``df`` with its whitened vectors (array of double) and deviations (long).

    The added columns get underscores after their names until no other column is called so.
    """
    name = free(name, df.columns)
    deviation = free(deviation, [*df.columns, name])
    held, size = df.sparkSession.sparkContext.broadcast(model), len(model.sums)
    schema = T.StructType([*df.schema.fields,
                           T.StructField(name, T.ArrayType(T.DoubleType())),
                           T.StructField(deviation, T.LongType())])
    at = df.columns.index(vector)

    def work(batches):
        own = held.value
        for batch in batches:
            for first in range(0, len(batch), ROWS):
                part = batch.slice(first, ROWS)
                rows, x = whole(part.column(at), size)
                shown, far = [None] * len(part), [None] * len(part)
                for i, w, d in zip(rows.tolist(), own.whiten(x), own.deviations(x)):
                    shown[i], far[i] = w, d
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(shown, pa.list_(pa.float64())),
                     pa.array(far, pa.int64())], names=schema.names)

    return df.mapInArrow(work, schema)


def report(embeddings: DataFrame, keep: int = 4) -> DataFrame:
    """A row per vec_id and component: n, deviation, whitened, explained, identity_error."""
    rows = embeddings.select("vec_id", "embedding")
    model = fit(rows, keep=keep)
    if model is None:
        model = Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
        rows = rows.where("false")
    shares = F.array(*[F.lit(float(e)) for e in model.explained]) if len(model.values) \
        else F.expr("cast(array() AS array<double>)")
    return whitened(rows, model).where("whitened IS NOT NULL").select(
        "vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", F.get(shares, F.col("_at")).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"))
