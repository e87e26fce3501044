"""Joins against a small key set whose size is checked, not assumed, and joins on keys that many rows share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def keep_keys(big: DataFrame, keys: DataFrame, on: str | Column | list, max_keys: int | None) -> DataFrame:
    """Rows of ``big`` whose key occurs in ``keys`` (a left-semi join).

    With ``max_keys`` the distinct key set is counted (one scalar); within the
    bound it is broadcast, so ``big`` is filtered where it is read and never
    shuffled for this join.  Beyond the bound (or without one) Spark plans the
    join itself (shuffle, or AQE's runtime choice).
    """
    k = keys.distinct()
    if max_keys is not None and k.count() <= max_keys:
        k = F.broadcast(k)
    return big.join(k, on, "left_semi")


def heavy_keys(owners: DataFrame, key: str, most: int, max_keys: int | None = None) -> DataFrame | None:
    """(``key``, blocks): the keys with more than ``most`` rows in ``owners`` and how many blocks of about ``most``
    rows they make; None where no key is that heavy.  Stored and counted; broadcast only within ``max_keys``."""
    n = owners.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    heavy = materialize(n.select(key, F.ceil(F.col("n") / most).cast("int").alias("blocks")))
    found = heavy.count()
    if found == 0:
        return None
    return F.broadcast(heavy) if max_keys is not None and found <= max_keys else heavy


def join_owners(rows: DataFrame, owners: DataFrame, key: str, heavy: DataFrame | None, owner: str,
                part: str | None = None, pieces: int = 8) -> DataFrame:
    """Inner join of ``rows`` with all ``owners`` of their ``key``; a heavy key is split on both sides.

    ``heavy`` comes from ``heavy_keys``.  The owners of a heavy key are dealt over its blocks by a hash of ``owner``
    and its rows over ``pieces`` by a hash of ``part`` (one piece without ``part``).  A row goes to every block, an owner
    to every piece, so each pair meets in exactly one (block, piece) and no task holds a whole key.  Other keys
    are in block 0, piece 0.
    """
    if heavy is None:
        return rows.join(owners, key)
    spread = pieces if part else 1
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    is_heavy = F.col("blocks").isNotNull()

    def number(column: str, n) -> Column:
        return F.when(is_heavy, F.pmod(F.xxhash64(column), n).cast("int")).otherwise(0)

    left = (rows.join(heavy, key, "left")
            .withColumn("_piece", number(part, F.lit(spread)) if part else F.lit(0))
            .withColumn("_block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("blocks"))
    right = (owners.join(heavy, key, "left").withColumn("_block", number(owner, F.col("blocks")))
             .withColumn("_piece", F.explode(F.sequence(F.lit(0), F.when(is_heavy, spread - 1).otherwise(0)))).drop("blocks"))
    return left.join(right, [key, "_block", "_piece"]).drop("_block", "_piece")
