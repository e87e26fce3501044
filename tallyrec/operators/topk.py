"""ML20: the exact ``k`` best items of every user by factor product, without scoring every pair.

Items lie in blocks of falling norm.  Every user meets the block of the largest norms first; its k-th best score
there is a bound, and by the Cauchy-Schwarz inequality a block whose largest norm times the user's norm stays below
that bound cannot hold a better item.  Only the blocks left open for a user are multiplied with it.  Users are salted
into groups of bounded size, so neither a block that all users need nor a user set of any size meets in one task: a task
multiplies one item block with one user group, and gives at most ``k`` rows a user.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

ITEMS, USERS = 4096, 8192  # rows of an item block, users of a group
ROWS = 512                 # users multiplied at a time within a group


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _norm(col: str):
    return F.sqrt(F.aggregate(F.col(col), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _products(users: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(user, item, score) of the ``k`` best items of each (user, block); ``users`` and ``items`` carry block and salt."""
    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"user": [], "item": [], "score": []}
        if left.num_rows and right.num_rows:
            right = right.sort_by("item")  # a stable sort by score then breaks ties by item
            ids, v, names = right["item"].to_pylist(), _matrix(right["vector"]), left["user"].to_pylist()
            u = _matrix(left["vector"])
            for at in range(0, len(u), ROWS):
                scores = np.floor(u[at:at + ROWS] @ v.T * 1e6 + 0.5) / 1e6
                least = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.full(len(scores), -np.inf)
                for row, (s, low) in enumerate(zip(scores, least, strict=True)):
                    near = np.flatnonzero(s >= low)
                    near = near[np.argsort(-s[near], kind="stable")][:k]
                    out["user"] += [names[at + row]] * len(near)
                    out["item"] += [ids[i] for i in near]
                    out["score"] += s[near].tolist()
        return pa.table({"user": pa.array(out["user"], pa.string()), "item": pa.array(out["item"], pa.string()),
                         "score": pa.array(out["score"], pa.float64())})

    return (users.select("block", "salt", "user", "vector").groupBy("block", "salt")
            .cogroup(items.select("block", "salt", "item", "vector").groupBy("block", "salt"))
            .applyInArrow(multiply, "user string, item string, score double"))


def top_products(users: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(user, item, score, place): the ``k`` items of the highest product per user, ties by item; exact.

    ``users``: (user, vector), ``items``: (item, vector), ids as strings, one row an id.
    """
    users, items = materialize(users.select("user", "vector")), materialize(items.select("item", "vector"))
    blocks = max(1, math.ceil(items.count() / ITEMS))
    salts = max(1, math.ceil(users.count() / USERS))
    laid = (items.withColumn("norm", _norm("vector")).repartitionByRange(blocks, F.desc("norm"), F.asc("item"))
            .withColumn("block", F.spark_partition_id()))
    laid = materialize(laid)  # block numbers stay: they are written
    heads = sorted((r["block"], r["head"]) for r in laid.groupBy("block").agg(F.max("norm").alias("head")).collect())
    users = users.withColumn("norm", _norm("vector")).withColumn("salt", F.pmod(F.xxhash64("user"), F.lit(salts)).cast("int"))
    if not heads:
        return users.select("user", F.lit("").alias("item"), F.lit(0.0).alias("score"), F.lit(1).alias("place")).limit(0)
    first = heads[0][0]
    all_salts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    top = materialize(_products(users.withColumn("block", F.lit(first)),
                                laid.where(F.col("block") == first).select("block", "item", "vector", all_salts), k))
    if len(heads) > 1:
        bound = top.groupBy("user").agg(F.when(F.count("*") == k, F.min("score")).alias("bound"))
        rest = F.array(*(F.struct(F.lit(b).alias("block"), F.lit(float(h)).alias("head")) for b, h in heads[1:]))
        open_ = F.filter(rest, lambda h: F.col("bound").isNull() | (F.col("norm") * h["head"] >= F.col("bound") - 1e-6))
        asked = materialize(users.join(bound, "user", "left").select("user", "vector", "salt", F.explode(open_).alias("h"))
                            .select("user", "vector", "salt", F.col("h.block").alias("block")))
        groups = asked.select(F.col("block").alias("b"), F.col("salt").alias("s")).distinct()
        wanted = (laid.join(groups, F.col("block") == F.col("b"))
                  .select("block", F.col("s").alias("salt"), "item", "vector"))
        top = top.unionByName(_products(asked, wanted, k))
    best = Window.partitionBy("user").orderBy(F.desc("score"), F.asc("item"))
    return top.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
