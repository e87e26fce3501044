"""Embedding near-duplicates with randomised-rotation binary codes (operator 1).

A unit vector x is turned by stacked random rotations R and kept as the signs of Rx, with two
correction factors: c, the inner product of the sign vector s (scaled to length 1) with Rx, and o, the
length of what else of s lies in the turned space.  For any unit y, <s, Ry> / c estimates <x, y>
without bias, with an error of about sqrt(1 - <x, y>^2) * o / c / sqrt(dim - 1); a pair is recomputed in double
precision unless even ``EPSILON`` such errors leave it below the threshold.

Candidates meet in tables keyed by the signs along a few random directions.  Every table has directions of its own, so
tables are independent of each other.  The number of bits follows the number of vectors, so
a table's usual bucket doesn't grow, and the number of tables follows from the bits so that a pair at the
threshold meets somewhere but for one in a million.  A bucket of many vectors is cut into blocks that
are compared pairwise in separate tasks.  A pair counts in the first table where it meets; tasks
return counts and a spanning star per vector, never pairs, so groups of copies don't grow the output.

Equal vectors are one class with a weight.  Vectors that are null, zero or hold null or non-finite components,
and rows of null id, link with nothing; vectors of different lengths never link.  Repeated rows are vectors of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.common import stored
from tallyrec.llm.components import components

CODE_BITS, EPSILON, MISS, BUCKET, BLOCK = 256, 6.0, 1e-6, 16, 512

GRID = 1 << 20  # steps in 1 of what table keys are computed from

_turns: dict[int, np.ndarray] = {}
_directions: dict[tuple[int, int, int], np.ndarray] = {}


def rotations(dim: int) -> np.ndarray:
    """dim x L matrix of stacked random rotations, scaled so that lengths stay; L is at least CODE_BITS."""
    if dim not in _turns:
        rng = np.random.default_rng(1_000_003 + dim)
        parts = [np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(-(-CODE_BITS // dim))]
        _turns[dim] = np.concatenate(parts, axis=1) / math.sqrt(len(parts))
    return _turns[dim]


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision (by the largest component first, against overflow)."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def tables(n: int, threshold: float) -> tuple[int, int]:
    """Bits of a key and number of tables for n vectors."""
    same = 1 - math.acos(threshold) / math.pi
    bits = min(40, max(4, math.ceil(math.log2(max(n, 1) / BUCKET)) if n > BUCKET else 4))
    return bits, math.ceil(math.log(MISS) / math.log(1 - same ** bits))


def directions(dim: int, bits: int, count: int) -> np.ndarray:
    """dim x (count * bits) normal directions, ``bits`` a table, as whole numbers of 1 / GRID."""
    if (dim, bits, count) not in _directions:
        rng = np.random.default_rng(77_000_003 + dim)
        _directions[dim, bits, count] = np.rint(rng.normal(size=(count * bits, dim)).T * GRID)
    return _directions[dim, bits, count]


def table_keys(x: np.ndarray, bits: int, count: int, first: int | None = None) -> np.ndarray:
    """Key of each row of the unit vectors x in each of the ``first`` tables (or all).

    Products and sums are whole numbers below 2^53, so a vector has the same keys in whatever matrix it stands.
    """
    turn = directions(x.shape[1], bits, count)[:, :bits * (count if first is None else first)]
    out = np.zeros((len(x), turn.shape[1] // bits), np.int64)
    for b in range(0, len(x), 1024):
        sign = np.rint(x[b:b + 1024] * GRID) @ turn >= 0
        out[b:b + 1024] = sign.reshape(len(sign), -1, bits) @ (1 << np.arange(bits))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def codes(classes: DataFrame, bits: int, count: int) -> DataFrame:
    """id, weight, dim, embedding, code (packed signs), c, o, keys (one a table)."""
    kind = classes.schema["embedding"].dataType

    def run(batches):
        for batch in batches:
            dims = np.array([len(v) for v in batch.column(2)])
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                turn = rotations(int(dim))
                x = unit(_matrix(part.column(2)))
                keys = table_keys(x, bits, count)
                x = x @ turn
                sign = x >= 0
                s = np.where(sign, 1.0, -1.0) / math.sqrt(x.shape[1])
                c = (s * x).sum(1)
                inside = s @ turn.T  # of the sign vector, in the space of the vectors
                o = np.sqrt(np.maximum((inside * inside).sum(1) - c * c, 0))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(np.full(len(x), dim, np.int32)), part.column(2),
                    pa.array([row.tobytes() for row in np.packbits(sign, axis=1)], pa.binary()),
                    pa.array(c), pa.array(o), pa.array(list(keys), pa.list_(pa.int64()))],
                    names=["id", "weight", "dim", "embedding", "code", "c", "o", "keys"])

    return classes.select("id", "weight", "embedding").mapInArrow(
        run, f"id long, weight long, dim int, embedding {kind.simpleString()}, code binary, c double, o double, keys array<long>")


class Group:
    """Links between two blocks of one bucket (or within one)."""

    def __init__(self, threshold: float, bits: int, count: int):
        self.threshold, self.bits, self.count = threshold, bits, count

    def compare(self, table: int, ids, weight, block, vectors, code, c, o):
        dim = vectors.shape[1]
        x = unit(vectors)
        turned = (x @ rotations(dim)).astype(np.float32)
        sign = np.unpackbits(code, axis=1)[:, :turned.shape[1]]
        s = ((2.0 * sign - 1) / math.sqrt(turned.shape[1])).astype(np.float32)
        left, right = np.flatnonzero(block == block[0]), np.flatnonzero(block == block[-1])
        # at the threshold the error is at most this, so a true link's estimate is not lower
        off = EPSILON * math.sqrt(max(1 - self.threshold ** 2, 0)) * o / c / math.sqrt(max(dim - 1, 1)) + 1e-3
        one = s[left] @ turned[right].T / c[left][:, None] + off[left][:, None]
        two = turned[left] @ s[right].T / c[right][None, :] + off[right][None, :]
        maybe = (one >= self.threshold) & (two >= self.threshold)
        if block[0] == block[-1]:
            maybe = np.triu(maybe, 1)
        i, j = np.nonzero(maybe)
        i, j = left[i], right[j]
        exact = np.concatenate([(x[i[b:b + 50_000]] * x[j[b:b + 50_000]]).sum(1) for b in range(0, max(len(i), 1), 50_000)])
        i, j = i[exact >= self.threshold], j[exact >= self.threshold]
        if not len(i):
            return None
        if table:
            keys = np.zeros((len(x), table), np.int64)
            some = np.union1d(i, j)
            keys[some] = table_keys(x[some], self.bits, self.count, table)
            met = np.concatenate([(keys[i[b:b + 20_000]] == keys[j[b:b + 20_000]]).any(1) for b in range(0, len(i), 20_000)])
            i, j = i[~met], j[~met]
            if not len(i):
                return None
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, i, weight[j])
        np.add.at(n, j, weight[i])
        root = ids.copy()
        while True:  # smallest id along the links
            low = root.copy()
            np.minimum.at(low, i, root[j])
            np.minimum.at(low, j, low[i])
            if (low == root).all():
                break
            root = low
        has = n > 0
        return ids[has], n[has], root[has]


def linked(coded: DataFrame, threshold: float, bits: int, count: int) -> DataFrame:
    """id, n, root: links of a vector counted in one group of a table, and the smallest id it reaches there."""
    posts = coded.select("id", "dim", F.posexplode("keys").alias("t", "key"))
    crowd = (posts.groupBy("dim", "t", "key").count().where(F.col("count") > 1)
             .select("dim", "t", "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    posts = posts.join(crowd, ["dim", "t", "key"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    two = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j")))
    posts = posts.withColumn("at", F.explode(two)).select("id", F.xxhash64("dim", "t", "key", "at.i", "at.j").alias("g"), "t", "block")
    rows = posts.join(coded.select("id", "weight", "embedding", "code", "c", "o"), "id")
    n = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (rows.select("g", "t", "block", "id", "weight", "c", "o", "code", "embedding").repartition(n, "g")
            .sortWithinPartitions("g", "block", "id"))

    def run(batches):
        group = Group(threshold, bits, count)

        def out(batch):
            g = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(g)) + 1, [len(g)]])
            found = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a < 2:
                    continue
                part = batch.slice(a, b - a)
                code = np.frombuffer(b"".join(part.column(7).to_pylist()), np.uint8).reshape(b - a, -1)
                got = group.compare(int(part.column(1)[0].as_py()), *[part.column(k).to_numpy() for k in (3, 4, 2)],
                                    _matrix(part.column(8)), code, part.column(5).to_numpy(), part.column(6).to_numpy())
                if got:
                    found.append(got)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found]), pa.int64()) for k in range(3)], names=["id", "n", "root"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            g = batch.column(0).to_numpy()
            last = int(np.searchsorted(g, g[-1]))  # the last group may go on in the next batch
            if last:
                yield from out(batch.slice(0, last))
            held = batch.slice(last)
        if held is not None:
            yield from out(held)

    return rows.mapInArrow(run, "id long, n long, root long")


def near_vectors(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding)."""
    rows = vectors.select("vec_id", "embedding")
    kind = rows.schema["embedding"].dataType.elementType
    limit = F.lit(float("inf"))
    good = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < limit)) & F.exists("embedding", lambda v: v != F.lit(0).cast(kind))
    rows = rows.withColumn("valid", F.coalesce(good, F.lit(False)) & F.col("vec_id").isNotNull())
    classes = stored(rows.where("valid").groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"),
                                                                 ), "embedding-classes")
    bits, count = tables(classes.count(), threshold)
    coded = stored(codes(classes, bits, count), "embedding-codes")
    found = stored(linked(coded, threshold, bits, count), "embedding-links")
    labels = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).where("a <> b"))
    counted = found.groupBy("id").agg(F.sum("n").alias("n"))
    named = (classes.join(counted, "id", "left").join(labels, "id", "left")
             .select("embedding", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    linked_rows = rows.where("valid").join(named, "embedding").select("vec_id", "n_links", "component_id")
    rest = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
