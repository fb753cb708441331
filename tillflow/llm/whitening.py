"""Whitening of embeddings: principal axes by mixed-precision refinement.

Entries become whole numbers, so counts, sums and second moments over any number of tasks
are exact and do not depend on how the rows are dealt out. The covariance (a square of the
dimension) goes to the driver, where float32 eigenvectors are corrected by the
matrix-multiplication iteration of Ogita and Aishima in extended precision; eigenvalues too
close to be told apart by it are rotated by a sub-solve within their cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.session import stored

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
WIDE = np.longdouble
ROUNDS = 60


# --- eigenvectors --------------------------------------------------------------

def corrected(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One iteration: (vectors, eigenvalues, the size of the correction). Pairs of eigenvalues
    nearer than the error of this round are only made orthogonal to each other."""
    rest = np.eye(len(matrix), dtype=WIDE) - vectors.T @ vectors
    turned = vectors.T @ (matrix @ vectors)
    values = np.diag(turned) / (1 - np.diag(rest))
    wrong = turned - np.diag(values)
    error = 2 * (np.linalg.norm(wrong.astype(float)) + np.linalg.norm(matrix.astype(float))
                 * np.linalg.norm(rest.astype(float)))
    gap = values[None, :] - values[:, None]
    near = np.abs(gap) <= error
    step = np.where(near, rest / 2, (turned + values[None, :] * rest) / np.where(near, 1, gap))
    return vectors + vectors @ step, values, float(np.abs(step).max())


def clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Places of eigenvalues that follow each other within ``width``: two and more of them."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > width) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def _orthonormal(vectors: np.ndarray) -> np.ndarray:
    """The nearest orthonormal columns, by Newton's iteration, for columns that nearly are."""
    for _ in range(4):
        vectors = vectors + vectors @ (np.eye(vectors.shape[1], dtype=WIDE) - vectors.T @ vectors) / 2
    return vectors


def refined(matrix: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Starts from float32 eigenvectors. A cluster is what the iteration can't tell apart at its
    error of that round: its part of the matrix, less its middle, is small, so a solve of that
    part alone tells its vectors apart by the cluster's own width. Clusters get narrower from
    round to round; what stays within the rounding of the numbers is an eigenspace, of which
    any orthonormal basis does.
    """
    size = len(matrix)
    wide = matrix.astype(WIDE)
    scale = float(np.abs(matrix).max()) if size else 0.0
    if not size or scale == 0:
        return np.zeros(size), np.eye(size)
    wide = wide / WIDE(scale)
    if start is None:
        start = np.linalg.eigh(wide.astype(np.float32))[1]
    vectors = _orthonormal(start.astype(WIDE))
    least = size * float(np.finfo(WIDE).eps)
    norm = float(np.linalg.norm(wide.astype(float)))
    change = None
    for _ in range(ROUNDS):
        turned = vectors.T @ (wide @ vectors)
        values = np.diag(turned)
        off = turned - np.diag(values)
        width = max(2 * float(np.linalg.norm(off.astype(float))), least * norm)
        for part in clusters(values.astype(float), width):
            middle = values[part].sum() / len(part)
            small = turned[np.ix_(part, part)] - np.eye(len(part), dtype=WIDE) * middle
            reach = np.abs(small).max()
            if reach > least * norm:
                turn = np.linalg.eigh((small / reach).astype(float))[1]
                vectors[:, part] = vectors[:, part] @ _orthonormal(turn.astype(WIDE))
        vectors, values, step = corrected(wide, vectors)
        if step <= 4 * least or (change is not None and step >= change and step <= 1e-17 * size):
            break
        change = step
    vectors = _orthonormal(vectors)
    values = np.diag(vectors.T @ (wide @ vectors))
    order = np.argsort(-values, kind="stable")
    return (values[order] * WIDE(scale)).astype(float), vectors[:, order].astype(float)


# --- moments -------------------------------------------------------------------

@dataclass
class Axes:
    """What whitening needs: the fit list's number and sums, and its leading axes."""

    n: int
    sums: list[int]
    values: np.ndarray  # all eigenvalues, falling
    vectors: np.ndarray  # dimension x components
    trace: float
    identity_error: float = 0.0

    @property
    def least(self) -> float:
        """Below it an eigenvalue is rounding: there is no variance to bring to one."""
        return len(self.sums) * np.finfo(float).eps * max(self.trace, 0.0)


def whole_numbers(vector: Column) -> Column:
    """floor(64 c) + 1,000,000 of every entry."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector has an entry and no null, infinite or undefined one."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                    & (F.abs(c.cast("double")) < float("inf")))
    return rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(good, F.lit(False)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _added(rows: DataFrame, name: str, width: int, work) -> list[list[int]]:
    """The sum over all tasks of the rows (place, values) that ``work`` makes of its batches: a
    square of whole numbers, added up by place in tasks of their own."""
    made = rows.mapInArrow(work, "place int, high binary, low binary").repartition("place")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for place, high, low in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                high, low = np.frombuffer(high, np.int64), np.frombuffer(low, np.int64)
                if place in totals:
                    high, low = totals[place][0] + high, totals[place][1] + low
                totals[place] = high + (low >> 31), low & (2**31 - 1)
        for place, (high, low) in totals.items():
            yield pa.RecordBatch.from_pydict({
                "place": pa.array([place], pa.int32()), "high": [high.tobytes()], "low": [low.tobytes()]})

    found = stored(made.mapInArrow(add, "place int, high binary, low binary"), name).collect()
    out = [[0] * width for _ in range(width)]
    for place, high, low in found:
        high, low = np.frombuffer(high, np.int64).tolist(), np.frombuffer(low, np.int64).tolist()
        out[place] = [(h << 31) + v for h, v in zip(high, low, strict=True)]
    return out


def _partial(width: int, moment):
    """Tasks' sums of a square of whole numbers: ``moment`` gives it for a slice of vectors."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros((width, width), np.int64), np.zeros((width, width), np.int64)
        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            low += moment(_matrix(batch.column(0)))
            high, low = high + (low >> 31), low & (2**31 - 1)
        if seen:
            yield pa.RecordBatch.from_pydict({
                "place": pa.array(range(width), pa.int32()),
                "high": [row.tobytes() for row in high], "low": [row.tobytes() for row in low]})
    return work


def exact_product(values: np.ndarray) -> np.ndarray:
    """values' values of whole numbers, exact: in doubles while all sums stay below 2^53, else in
    64-bit integers, which hold sums of a batch."""
    reach = int(np.abs(values).max()) if values.size else 0
    if reach * reach * len(values) < 2**53:
        wide = values.astype(float)
        return (wide.T @ wide).astype(np.int64)
    if reach * reach * len(values) < 2**63:
        return values.T @ values
    raise OverflowError(f"entries of {reach} are too far from their mean for exact sums")


def axes(fit: DataFrame, width: int, components: int = COMPONENTS) -> Axes:
    """The axes of the distinct vectors ``fit`` (x: array of long, all of the same length)."""
    one = fit.select(F.posexplode("x").alias("place", "v")).groupBy("place").agg(
        F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n")).collect()
    sums = [0] * width
    n = 0
    for place, s, rows in one:
        sums[place], n = int(s), rows
    if not n:
        return Axes(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    # Rounded means: centring by whole numbers keeps products small and exact; what the
    # rounding leaves is taken off afterwards, exactly too.
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    second = _added(fit.select("x"), "second-moments", width, _partial(
        width, lambda x: exact_product(x - centre)))
    left = [s - n * int(c) for s, c in zip(sums, centre.tolist(), strict=True)]
    covariance = np.empty((width, width), WIDE)
    for i in range(width):
        for j in range(width):
            top = n * second[i][j] - left[i] * left[j]
            covariance[i, j] = _quotient(top, n * n)
    values, vectors = refined(covariance)
    found = Axes(n, sums, values, vectors[:, :components], float(np.trace(covariance)))
    found.identity_error = _identity_error(fit, found)
    return found


def _quotient(top: int, bottom: int) -> np.longdouble:
    """top / bottom to more than double precision."""
    first = float(Fraction(top, bottom))
    return WIDE(first) + WIDE(float(Fraction(top, bottom) - Fraction(first)))


def _projected(x: np.ndarray, found: Axes) -> np.ndarray:
    """The whitened coordinates of vectors; undefined on axes without variance."""
    mean = [divmod(s, found.n) for s in found.sums]
    whole = np.array([q for q, _ in mean], np.int64)
    part = np.array([r / found.n for _, r in mean])
    values = found.values[:found.vectors.shape[1]]
    scale = np.where(values > found.least, np.sqrt(np.maximum(values, 0)), np.nan)
    return ((x - whole) - part) @ found.vectors / scale


def _identity_error(fit: DataFrame, found: Axes) -> float:
    """The largest entry of the covariance of the fit list's whitened vectors minus the identity,
    over the axes with variance, from one more pass over the list. Products are added as whole
    numbers of 2^-40: sums over any number of tasks lose nothing more."""
    good = found.values[:found.vectors.shape[1]] > found.least
    if not good.any():
        return 0.0
    unit = 2.0**40
    kept = Axes(found.n, found.sums, found.values[:len(good)][good], found.vectors[:, good], found.trace)
    count = int(good.sum())

    def products(x: np.ndarray) -> np.ndarray:
        w = _projected(x, kept)
        out = np.zeros((count + 1, count + 1), np.int64)
        for a in range(0, len(w), 1024):  # a few rows at once keep the rounded sums small
            part = w[a:a + 1024]
            out[:count, :count] += np.rint(part.T @ part * unit).astype(np.int64)
            out[count, :count] += np.rint(part.sum(axis=0) * unit).astype(np.int64)
        return out

    total = _added(fit.select("x"), "whitened-moments", count + 1, _partial(count + 1, products))
    mean = [v / unit / found.n for v in total[count][:count]]
    return max(abs(total[i][j] / unit / found.n - mean[i] * mean[j] - (i == j))
               for i in range(count) for j in range(count))


def whiten(rows: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """Per usable row and component: vec_id, component (from 1), n, deviation (decimal: the sum over
    dimensions of (n x - S)^2, exact), whitened, explained, identity_error.

    x are the entries as `whole_numbers` says. The axes are fitted to each distinct x once, n of
    them with sums S. Rows without a vector, with an empty one or with a null, infinite or
    undefined entry are left out; so are vectors of another length than most of the distinct ones
    (of equally frequent lengths the longest counts). Rows that repeat an id or a vector are
    answered each. Axes without variance, beyond rounding, have a null coordinate. There are
    ``components`` rows for a vector, fewer if its dimension is less; an empty table gives an
    empty one; other columns are ignored. The driver holds matrices of the dimension squared.
    """
    vectors = stored(usable(rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")), "vector").select(
        "vec_id", whole_numbers(F.col("vector")).alias("x")), "vectors")
    distinct = stored(vectors.select("x").distinct(), "distinct-vectors")
    lengths = distinct.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = lengths.width if lengths else 0
    of_width = F.size("x") == width
    found = axes(distinct.where(of_width), width, components)
    explained = [float(v / found.trace) if found.trace > 0 else None for v in found.values[:components]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.array(found.sums, object), len(explained)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            whitened = _projected(x, found)
            deviation = deviations(x, found.n, sums)
            places = np.repeat(np.arange(batch.num_rows), count)
            flat = whitened.ravel()
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(places)),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), batch.num_rows)),
                pa.array([deviation[p] for p in places.tolist()], pa.string()),
                pa.array(flat, mask=np.isnan(flat)),
                pa.array(explained * batch.num_rows, pa.float64()),
            ], names=["vec_id", "component", "deviation", "whitened", "explained"])

    answers = vectors.where(of_width).mapInArrow(
        work, "vec_id long, component int, deviation string, whitened double, explained double")
    return answers.select(
        "vec_id", "component", F.lit(found.n).cast("long").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened", "explained",
        F.lit(found.identity_error).alias("identity_error"))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[str]:
    """The sum over dimensions of (n x - S)^2 for every vector, exact."""
    top = int(np.abs(x).max()) if x.size else 0
    if n * top < 2**62 and max(map(abs, sums.tolist()), default=0) < 2**62:
        apart = n * x - sums.astype(np.int64)
        reach = int(np.abs(apart).max()) if apart.size else 0
        if reach * reach * max(1, x.shape[1]) < 2**63:
            return [str(v) for v in (apart * apart).sum(axis=1).tolist()]
    apart = n * x.astype(object) - sums
    return [str(v) for v in (apart * apart).sum(axis=1).tolist()]
