"""Embedding whitening: Golub-Kahan-Lanczos bidiagonalisation of the centred fit list, in blocks.

The fit list (each distinct integer vector x = floor(256 * c) once) is a table; the matrix X of its centred rows is
never gathered.  A step is two distributed products, X v and X' u.  A left vector u has one entry a row, so it is
kept as a short vector w with u = X w: every task makes its entries anew, and only sums of the width of a vector
leave the tasks.  Both sides are fully reorthogonalised, the left one twice (once after X v, once after X' u).
Steps take as many vectors at once as components are asked for (the block form of the method): so many equal
eigenvalues are all found, and the table is read that much less often.  The small matrix U' X V is bidiagonal
in blocks; its singular values s give the eigenvalues s * s / n, its right vectors the components.  Steps end when the
residuals of the components wanted are at rounding, or when no direction is left.

Sums S are exact integers; ``deviation`` is exact and null where it does not fit a long.

Nulls, null or non-finite entries: the row is left out.  A vector shorter than the longest counts as filled with
zeros.  Ties (equal eigenvalues): some orthogonal basis of their space, the same for all rows.  Repeated rows: each is
returned, once in the fit list.  Components without variance (beyond the rank; a single vector; an empty table) have no
rows.  Other columns are left aside, whatever their names.  Entries beyond 2**63 / 256 count as 2**63 / 256.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyrec.llm.common import stored

COMPONENTS = 4
CELLS = 1 << 18     # entries of a matrix that a task works on at a time
CONVERGED = 1e-14   # residual of a component, as a part of the largest singular value
NOISE = 1e-14       # squared length, as a part of the largest seen, under which a direction is rounding


@dataclass
class Whitening:
    """What whitening needs to know of the fit list."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # one unit column a component
    values: np.ndarray   # eigenvalues of the covariance, falling
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def integers(vectors: DataFrame, width: int | None = None) -> DataFrame:
    """(vec_id, x) of the rows that remain; with ``width``, x is filled with zeros up to it."""
    e = F.col("embedding")
    sound = F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    rows = (vectors.select("vec_id", "embedding").where(e.isNotNull() & sound)
            .select("vec_id", F.transform(e, lambda c: F.floor(c.cast("double") * 256)).alias("x")))
    if width is None:
        return rows
    return rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))))


def matrices(column: pa.ListArray, width: int) -> Iterator[np.ndarray]:
    """Rows of an Arrow column of equally long lists, as matrices of a bounded size."""
    step = max(1, CELLS // width)
    for i in range(0, len(column), step):
        yield column.slice(i, step).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def exact_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and sum of every dimension, as integers."""
    def partial(batches):
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            for x in matrices(batch.column(0), width):
                small = abs(x.min()) < 1 << 40 and abs(x.max()) < 1 << 40
                n, total = n + len(x), total + (x.sum(0).astype(object) if small else x.astype(object).sum(0))
        if n:
            cells = [n, *map(int, total)]
            yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()),
                                              pa.array([Decimal(c) for c in cells], pa.decimal128(38, 0))], ["cell", "v"])

    got = {r["cell"]: int(r["v"]) for r in fit.select("x").mapInArrow(partial, "cell int, v decimal(38,0)")
           .groupBy("cell").agg(F.sum("v").alias("v")).collect()}
    return got.get(0, 0), [got.get(i + 1, 0) for i in range(width)]


def product(fit: DataFrame, mean: np.ndarray, against: np.ndarray, by: np.ndarray, back: bool = False) -> np.ndarray:
    """Sum over all centred rows x of [x A, x B, x if ``back``, |x|]' (x B): one pass, a small matrix.

    The last row holds the sum of |x|**2 in its first place (the trace of X' X).
    """
    width, b = len(mean), by.shape[1]
    sides = np.hstack([against, by])
    high = sides.shape[1] + back * width + 1

    def partial(batches):
        total = np.zeros((high, b))
        some = False
        for batch in batches:
            for m in matrices(batch.column(0), width):
                x = m - mean
                y = x @ sides
                right = y[:, -b:]
                total[:sides.shape[1]] += y.T @ right
                if back:
                    total[sides.shape[1]:-1] += x.T @ right
                total[-1, 0] += np.einsum("ij,ij->", x, x)
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["cell", "v"])

    out = np.zeros(high * b)
    for r in fit.select("x").mapInArrow(partial, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():
        out[r["cell"]] = r["v"]
    return out.reshape(high, b)


def roots(gram: np.ndarray, least: float) -> np.ndarray:
    """T with T' gram T = I, over the directions of ``gram`` longer than ``least``."""
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    keep = value > least
    return vector[:, keep] / np.sqrt(value[keep])


def bidiagonalise(fit: DataFrame, mean: np.ndarray, components: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``components`` largest singular values of X, their right vectors, and the trace of X' X."""
    width = len(mean)
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, min(components, width))))[0]
    v, w, g = np.zeros((width, 0)), np.zeros((width, 0)), np.zeros((width, 0))  # U = X w, g = X' U
    scale = trace = 0.0
    while True:
        # X v, without what the left vectors so far hold of it
        b = block.shape[1]
        got = product(fit, mean, w, block)
        c, q, trace = got[:w.shape[1]], got[w.shape[1]:-1], got[-1, 0]
        v = np.hstack([v, block])
        scale = max(scale, float(np.linalg.eigvalsh(q)[-1]) if b else 0.0)
        if not scale:
            return np.zeros(0), np.zeros((width, 0)), trace
        new = (block - w @ c) @ roots(q - c.T @ c, NOISE * scale)
        if new.shape[1]:
            # X' u, and the left vectors once more
            got = product(fit, mean, w, new, back=True)
            m = w.shape[1]
            d, h, x = got[:m], got[m:m + new.shape[1]], got[m + new.shape[1]:-1]
            turn = roots(h - d.T @ d, 0.25)
            w, g = np.hstack([w, (new - w @ d) @ turn]), np.hstack([g, (x - g @ d) @ turn])
        left, s, right = np.linalg.svd(g.T @ v, full_matrices=False)
        k = min(components, int((s > np.sqrt(NOISE) * s[0]).sum())) if len(s) else 0
        off = np.linalg.norm(g @ left[:, :k] - v @ right[:k].T * s[:k], axis=0) if k else np.zeros(0)
        rest = g[:, m:] if new.shape[1] else np.zeros((width, 0))
        for _ in range(2):
            rest = rest - v @ (v.T @ rest)
        part, size, _ = np.linalg.svd(rest, full_matrices=False)
        block = part[:, size > np.sqrt(NOISE * scale) * 1e-6]
        block = block[:, :max(0, width - v.shape[1])]
        if not block.shape[1] or (k == min(components, width) and (off <= CONVERGED * s[0]).all()):
            return s[:k], v @ right[:k].T, trace


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Learn the components of all distinct vectors."""
    width = integers(vectors).agg(F.max(F.size("x")).alias("d")).first()["d"] or 0
    none = Whitening(0, [0] * width, np.zeros((width, 0)), np.zeros(0), 0.0)
    if not width:
        return none
    listed = stored(integers(vectors, width).select("x").distinct(), "whitening-fit")
    n, sums = exact_sums(listed, width)
    if not n:
        return none
    model = Whitening(n, sums, none.vectors, none.values, 0.0)
    s, model.vectors, trace = bidiagonalise(listed, model.mean, components)
    model.values, model.trace = s * s / n, trace / n
    if len(s):
        ones = model.vectors / np.sqrt(model.values)
        got = product(listed, model.mean, np.zeros((width, 0)), ones)
        model.identity_error = float(np.abs(got[:len(s)] / n - np.eye(len(s))).max())  # the rows are centred: their mean is 0
    return model


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S) ** 2 of each row; None beyond a long."""
    most = n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, sums))
    if x.shape[1] * most * most < 1 << 62:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(1)
    return [v if v < 1 << 63 else None for v in exact.tolist()]


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """One row a remaining vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    out = T._parse_datatype_string(
        f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, "
        "whitened double, explained double, identity_error double")
    if not len(model.values):
        return vectors.sparkSession.createDataFrame([], out)
    n, sums, mean, width = model.n, model.sums, model.mean, len(model.sums)
    turn, part, error, k = model.vectors / np.sqrt(model.values), model.values / model.trace, model.identity_error, len(model.values)

    def apply(batches):
        arrow = to_arrow_schema(out)
        for batch in batches:
            at = 0
            for x in matrices(batch.column(1), width):
                m, ids = len(x), batch.column(0).slice(at, len(x))
                at += m
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n)),
                    pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(each)), pa.array(((x - mean) @ turn).ravel()),
                    pa.array(np.tile(part, m)), pa.array(np.full(m * k, error))], schema=arrow)

    return integers(vectors, width).select("vec_id", "x").mapInArrow(apply, out)
