"""Deterministic hashing and exact ranks without a single-partition window.

``hash_rank`` numbers rows 1..n in md5 order exactly like
``row_number() OVER (ORDER BY md5(key), key)`` but stays distributed: rows are
bucketed by the md5 prefix, each bucket is ranked on its own, and a bucket
offset table (at most 2**bits rows, broadcast) shifts the local ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def md5_key(*cols: Column | str, salt: str | None = None) -> Column:
    parts = ([F.lit(salt)] if salt is not None else []) + [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def md5_bucket100(c: Column) -> Column:
    """0..99 from the first 32 bits of md5: a repeatable stand-in for ``random() * 100``."""
    return F.pmod(F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long"), F.lit(100)).cast("int")


def hash_rank(df: DataFrame, key_cols: list[str], salt: str, out: str = "rank", bits: int = 16) -> DataFrame:
    """Add ``out`` = exact 1-based position of each row in (md5(salt|keys), keys) order."""
    hex_digits = bits // 4
    h = md5_key(*key_cols, salt=salt)
    keyed = df.withColumn("_h", h).withColumn("_b", F.conv(F.substring("_h", 1, hex_digits), 16, 10).cast("int"))
    counts = keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    # <= 2**bits rows: a bounded, single-partition running sum is fine here.
    offsets = counts.select(
        "_b", (F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"))
    local = keyed.withColumn(
        "_r", F.row_number().over(Window.partitionBy("_b").orderBy("_h", *key_cols)))
    return (
        local.join(F.broadcast(offsets), "_b")
        .withColumn(out, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_r")).cast("long"))
        .drop("_h", "_b", "_r", "_off")
    )


def smallest_hashes(df: DataFrame, n: int, key_cols: list[str], salt: str) -> DataFrame:
    """The ``n`` rows that come first in (md5(salt|keys), keys) order; exact, at any number of input splits.

    A plain top-n sends ``n`` rows of every split to one task.  Here the rows are counted first; a cutoff on the hash
    leaves about ``n`` plus a margin of four standard deviations of them, wherever they lie, and only these are
    ordered.  If too few remain (a rare draw, or many equal keys) the cutoff is doubled.  ``df`` is read once a pass: give a
    stored table where it is dear.
    """
    total = df.count()
    if total <= n:
        return df
    h = md5_key(*key_cols, salt=salt)
    part = F.conv(F.substring(h, 1, 15), 16, 10).cast("long")  # the first 60 bits
    share = (n + 4 * n ** 0.5 + 16) / total
    while True:
        near = df if share >= 1 else df.where(part < F.lit(int(share * (1 << 60))))
        if share >= 1 or near.count() >= n:
            return near.orderBy(h, *key_cols).limit(n)
        share *= 2
