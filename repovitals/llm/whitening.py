"""Whitening of embeddings by shifted CholeskyQR.

The centred rows C are never factored in one place. A pass over them adds up the Gram matrix of the
rows as they are, C times the inverses of the triangular factors found so far, by triangular solves
in the tasks; its Cholesky factor is the next one. The first Gram matrix gets a shift, without which
an ill-conditioned C has no Cholesky factor in floating point; passes are repeated until the rows are
orthonormal. The product R of the factors has the singular values and right singular vectors of C, at
the accuracy of C itself rather than of its square, so the SVD of R gives the whitening components.

C is held to have d more rows, a multiple of the identity that is nothing beside the data, so that a
table whose vectors do not span all dimensions has factors too. They are taken off the eigenvalues again.

The driver and each task hold a few matrices of d x d for vectors of d entries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import sliced
from .storage import stored, workspace

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Greatest absolute value of a scaled entry: whole numbers up to here are exact as doubles.
LIMIT = 2.0**52
#: Rows count as orthonormal when their Gram matrix is this close to the identity.
ORTHONORMAL = 1e-13
MOST_PASSES = 12
#: The rows added to the centred ones, beside the norm of these.
FLOOR = 1e-13
#: Components of a standard deviation below this share of the greatest are left out: rounding hides them.
RANK = 1e-11
_UNIT = np.finfo(np.float64).eps / 2

Centre = tuple[np.ndarray, np.ndarray]


def _matrix(batch: pa.RecordBatch, name: str, dtype) -> np.ndarray:
    column = batch.column(name)
    return np.asarray(column.flatten(), dtype=dtype).reshape(len(column), -1)


def _scaled_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        entries = _matrix(batch, "embedding", np.float64)
        whole = np.floor(SCALE * entries).astype(np.int64) + OFFSET
        ends = pa.array(np.arange(0, whole.size + 1, whole.shape[1], dtype=np.int32))
        lists = pa.ListArray.from_arrays(ends, pa.array(whole.reshape(-1)))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists], names=["vec_id", "x"])


def _column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (at, total): of a task, the sum of each entry, and at -1 the number of rows."""
    total, n = None, 0
    for batch in batches:
        if batch.num_rows:
            # Halves of 32 bits, so that no sum of a batch overflows.
            x = _matrix(batch, "x", np.int64)
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            own = [(int(h) << 32) + int(w) for h, w in zip(high, low, strict=True)]
            total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
            n += len(x)
    if n:
        values = [str(v) for v in (n, *total)]
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(-1, len(total)), pa.int32()), "total": values})


def centred(x: np.ndarray, centre: Centre) -> np.ndarray:
    """x less the mean, which comes as its whole part and the rest: the difference is exact to the last bit."""
    return (x - centre[0]).astype(np.float64) - centre[1]


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular factor, by forward substitution."""
    out = np.empty_like(rows)
    for j in range(len(factor)):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def _gram(rows_of: Callable[[pa.RecordBatch], np.ndarray]):
    """Rows (at, total): of a task, the upper triangle of its rows' Gram matrix, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                rows = rows_of(batch)
                own = rows.T @ rows
                total = own if total is None else total + own
        if total is not None:
            upper = total[np.triu_indices(len(total))]
            yield pa.RecordBatch.from_pydict({"at": pa.array(range(len(upper)), pa.int32()), "total": upper})

    return run


def gram(frame: DataFrame, rows_of: Callable[[pa.RecordBatch], np.ndarray], d: int) -> np.ndarray:
    """The Gram matrix of all rows that rows_of makes of the frame's batches: d * (d + 1) / 2 numbers come back."""
    sums = frame.mapInArrow(sliced(_gram(rows_of)), "at int, total double").groupBy("at").agg(F.sum("total").alias("total"))
    upper = np.zeros(d * (d + 1) // 2)
    for at, total in sums.collect():
        upper[at] = total
    out = np.zeros((d, d))
    out[np.triu_indices(d)] = upper
    return out + np.triu(out, 1).T


def _factor(matrix: np.ndarray, shift: float) -> np.ndarray:
    """The upper Cholesky factor, with as much shift as it takes."""
    while True:
        try:
            return np.linalg.cholesky(matrix + shift * np.eye(len(matrix))).T
        except np.linalg.LinAlgError:
            shift = max(100 * shift, 100 * len(matrix) * _UNIT * np.trace(matrix))


def triangular_factor(gram_of: Callable[[list[np.ndarray]], np.ndarray], n: int, d: int) -> tuple[np.ndarray, float]:
    """(R, floor): R'R = C'C + floor * I for the centred rows C, of which gram_of gives Gram matrices.

    gram_of takes the factors by which the rows are solved first.
    """
    factors: list[np.ndarray] = []
    now = gram_of(factors)
    norm = float(np.linalg.eigvalsh(now)[-1])
    floor = FLOOR**2 * norm
    if norm == 0:
        return np.zeros((d, d)), 0.0
    shift = min(11 * (n * d + d * (d + 1)) * _UNIT, 1 / 64) * norm
    whole = np.eye(d)
    for _ in range(MOST_PASSES):
        added = solved(np.sqrt(floor) * np.eye(d), whole)
        now = now + added.T @ added
        factors.append(_factor(now, shift))
        whole = factors[-1] @ whole
        if np.abs(now - np.eye(d)).max() <= ORTHONORMAL * d:
            break
        shift = 0.0
        now = gram_of(factors)
    return whole, floor


def _whitened_rows(centre: Centre, rest: np.ndarray, n: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, "x", np.int64)
            away = x - centre[0]
            rough = ((n * away.astype(np.float64) - rest) ** 2).sum(axis=1)
            if len(x) and rough.max() < 2**62:
                deviation = [int(v) for v in ((n * away - rest) ** 2).sum(axis=1)]
            else:  # beyond 64 bits on the way, or in the end
                deviation = [sum((n * int(a) - int(r)) ** 2 for a, r in zip(row, rest, strict=True)) for row in away]
            deviation = [v if v < 2**63 else None for v in deviation]
            values = centred(x, centre) @ weights
            ends = pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(values).reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(deviation, pa.int64()), lists], names=["vec_id", "deviation", "values"]
            )

    return run


def whiten(embeddings: DataFrame, components: int = 32) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error): each vector, whitened.

    embeddings: vec_id, embedding. Entries c become whole numbers x = floor(64 * c) + 1000000; n is the
    number of vectors, S their sum. Components are the unit eigenvectors of the covariance of x (divisor
    n), numbered from 1 by falling eigenvalue, at most `components` of them; the entry of greatest
    absolute value of each is positive. deviation: the sum over dimensions of (n * x - S) ** 2, exact, NULL
    beyond 64 bits. whitened: x - S / n along the component, over the eigenvalue's square root. explained: the
    eigenvalue's share of the trace. identity_error: by how much, at most, an entry of the covariance
    of what came out differs from the identity.

    Rows with a NULL vector or a NULL or not finite entry are left out, and so are vectors of another
    length than most have (of equally frequent lengths the least counts), or none, and those with an entry
    beyond about 7 * 10**13, which no whole number of a double's precision stands for. Repeated rows count
    as often as they are there; a NULL vec_id is kept. Components without variance cannot be whitened and
    are left out, so a table of equal vectors gives no rows, nor does an empty one. With equal
    eigenvalues any basis of their space is right. Other columns are not read.
    """
    spark = embeddings.sparkSession
    folder = workspace(spark)
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    entries = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), entries.alias("embedding"))
    usable = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < LIMIT))
    rows = rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(usable)
    lengths = rows.groupBy(F.size("embedding").alias("length")).count().orderBy(F.desc("count"), "length").first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    d = int(lengths["length"])
    x = stored(
        rows.where(F.size("embedding") == d).mapInArrow(sliced(_scaled_rows), "vec_id long, x array<long>"), f"{folder}/x"
    )
    totals = dict(
        x.select("x").mapInArrow(sliced(_column_sums), "at int, total string")
        .groupBy("at")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .collect()
    )
    n = int(totals.pop(-1))
    whole, rest = np.array([divmod(int(totals[i]), n) for i in range(d)], dtype=np.int64).T
    centre = (whole, rest / n)

    def gram_of(factors: list[np.ndarray]) -> np.ndarray:
        def rows_of(batch: pa.RecordBatch) -> np.ndarray:
            now = centred(_matrix(batch, "x", np.int64), centre)
            for factor in factors:
                now = solved(now, factor)
            return now

        return gram(x.select("x"), rows_of, d)

    factor, floor = triangular_factor(gram_of, n, d)
    _, singular, directions = np.linalg.svd(factor)
    values = np.maximum(singular**2 - floor, 0.0) / n
    kept = int((singular > RANK * singular[0]).sum()) if singular[0] > 0 else 0
    kept = min(components, kept)
    if not kept:
        return spark.createDataFrame([], schema)
    axes = directions[:kept]
    axes = axes * np.sign(axes[np.arange(kept), np.abs(axes).argmax(axis=1)])[:, None]
    weights = (axes / np.sqrt(values[:kept])[:, None]).T
    out = stored(
        x.mapInArrow(sliced(_whitened_rows(centre, rest, n, weights)), "vec_id long, deviation long, values array<double>"),
        f"{folder}/whitened",
    )
    means = np.zeros(kept)
    for at, mean in out.select(F.posexplode("values").alias("at", "v")).groupBy("at").agg(F.avg("v")).collect():
        means[at] = mean
    covariance = gram(out.select("values"), lambda batch: _matrix(batch, "values", np.float64) - means, kept) / n
    error = float(np.abs(covariance - np.eye(kept)).max())
    explained = F.array(*(F.lit(float(v)) for v in values[:kept] / values.sum()))
    return out.select("vec_id", "deviation", F.posexplode("values").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, "at").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
