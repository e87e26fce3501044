"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyrec.session import scratch_path


BATCH_ROWS = 2000  # rows of an Arrow batch of texts
BATCH_BYTES = 4_000_000  # and its size, but for a longer row


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step table to the shared folder and read it back: lineage ends, columns stay prunable."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


LONGEST = 100_000  # characters of the longest text that a training sample takes: with its number of rows the bound of what the driver gets


def below(rank: Column, share: float | Column) -> Column:
    """Whether a 64-bit hash lies in the lowest ``share`` of its range."""
    return rank.cast("double") < (F.lit(share) if isinstance(share, float) else share) * 2.0 ** 64 - 2.0 ** 63


def lowest(df: DataFrame, rank: Column, n: int, keep: Column, key: str) -> DataFrame:
    """Rows of ``df`` that ``keep`` accepts and that include those of the ``n`` values of ``key`` with the lowest ``rank`` (a hash of it): about so many, or a few more.

    A plain top-n sends n rows of every split to one task.  Here a cutoff on the hash, from the number of rows, leaves about n
    rows wherever they lie; it is raised by what was found while fewer than n are left.
    """
    share = (n + 4 * n ** 0.5 + 16) / max(df.count(), 1)
    while share < 1:
        near = df.where(below(rank, share)).where(keep)
        found = near.select(key).distinct().count()
        if found >= n:
            return near
        share *= max(2.0, min(100.0, 1.2 * n / max(found, 1)))
    return df.where(keep)


BITMAP = 1 << 15  # bits of one value of bitmap_construct_agg
MOST_BITS = 1 << 26  # of all bitmaps of a key filter: 8 MB, which is what an executor gets of it at most


def maybe_among(df: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with the boolean column ``name``: false where ``key`` is surely not in the column ``key`` of ``keys`` or is null.

    A semi or anti join of long rows with a table too large to broadcast shuffles all of them.  Sixteen bits a key, one of them set
    by the key's hash, are broadcast instead, so that only the rows they can't tell (about one in sixteen of the others, more
    where there are over 4 million keys) have to meet ``keys``.
    """
    bits = BITMAP
    while bits < min(16 * keys.count(), MOST_BITS):
        bits *= 2
    at = F.pmod(F.xxhash64(F.col(key).cast(keys.schema[key].dataType)), F.lit(bits))
    maps = (keys.where(F.col(key).isNotNull()).select(at.alias("_at"))
            .groupBy(F.floor(F.col("_at") / BITMAP).alias("_map")).agg(F.bitmap_construct_agg(F.col("_at") % BITMAP).alias("_bits")))
    place = (at % BITMAP).cast("int")
    byte = F.conv(F.hex(F.substr("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = df.withColumn("_map", F.floor(at / BITMAP)).join(F.broadcast(maps), "_map", "left")
    found = F.col(key).isNotNull() & F.coalesce(F.getbit(byte, place % 8) == 1, F.lit(False))
    return met.select(*df.columns, found.alias(name))


def only_among(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``keys``; few of the others are shuffled."""
    return maybe_among(df, keys, key, "_maybe").where("_maybe").drop("_maybe").join(keys, key, "left_semi")


def doc_hash(col: str = "doc_id"):
    """crc32 of the id as text: the fold rule of the labelled samples (a null id counts as 0)."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(0).cast("long"))


def parts(batch: pa.RecordBatch, weight: int | None, budget: int) -> Iterator[pa.RecordBatch]:
    """An Arrow batch in slices of about ``budget`` bytes of column ``weight``."""
    n = batch.num_rows
    if weight is None:
        yield batch
        return
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(weight)), 0).to_pylist()
    begin, load = 0, 0
    for i, s in enumerate(sizes):
        load += s
        if load >= budget or i == n - 1:
            yield batch.slice(begin, i + 1 - begin)
            begin, load = i + 1, 0


def slices(batch: pa.RecordBatch, weight: int | None, budget: int) -> Iterator[list[list]]:
    """As ``parts``, every slice as column lists."""
    for part in parts(batch, weight, budget):
        yield [c.to_pylist() for c in part.columns]


def give_back() -> None:
    """Hand memory that is no longer used back to the system: a worker serves the tasks of later stages too."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # glibc
        trim(0)


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in batches of at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES``; after a task's last row its worker gives memory back.

    Texts are long: with the defaults of 10,000 rows and 64 MB a batch of them takes tens of MB on both sides of the pipe.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf.set(size, conf.get(size, str(BATCH_BYTES)))  # a setting of the session stays

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(whole, schema)


def map_slices(df: DataFrame, make: Callable, schema: str, text: str | None = "text",
               budget: int = 2_000_000, lists: bool = True) -> DataFrame:
    """``make()`` runs once per task and returns ``f(*columns) -> list of output columns``.

    ``f`` gets the columns of ``df`` as Python lists (or, without ``lists``, as Arrow arrays, memory given back after each), a
    bounded slice at a time, so a worker never holds more than one slice beside its Arrow batch.  If ``f`` has
    ``finish``, it gives the last rows of the task.
    """
    struct = T._parse_datatype_string(schema)
    weight = df.columns.index(text) if text else None

    def run(batches):
        out = to_arrow_schema(struct)
        f = None

        def rows(got):
            return pa.RecordBatch.from_arrays([pa.array(c, type=out.field(i).type) for i, c in enumerate(got)], schema=out)

        for batch in batches:
            if not batch.num_rows:
                continue
            f = f or make()
            for part in parts(batch, weight, budget):
                yield rows(f(*(c.to_pylist() if lists else c for c in part.columns)))
                if not lists:
                    give_back()
        if hasattr(f, "finish"):
            yield rows(f.finish())

    return map_arrow(df, run, struct)


def filter_texts(df: DataFrame, make: Callable, text: str = "text", budget: int = 500_000) -> DataFrame:
    """The rows for whose texts ``f = make()`` gives True, all columns kept; ``f`` gets a bounded slice at a time."""
    at = df.columns.index(text)

    def run(batches):
        f = None
        for batch in batches:
            f = f or make()
            for part in parts(batch, at, budget):
                yield part.filter(pa.array(f(part.column(at).to_pylist()), pa.bool_()))

    return map_arrow(df, run, df.schema)


def replace_texts(df: DataFrame, make: Callable, text: str = "text", budget: int = 1_000_000) -> DataFrame:
    """All rows and columns, the texts replaced by those that ``f = make()`` gives for a bounded slice at a time."""
    at = df.columns.index(text)

    def run(batches):
        f = None
        for batch in batches:
            f = f or make()
            for part in parts(batch, at, budget):
                yield part.set_column(at, part.schema.field(at), pa.array(f(part.column(at).to_pylist()), part.schema.field(at).type))

    return map_arrow(df, run, df.schema)


class Recent(dict):
    """Word cache of at most about ``2 * limit`` entries: two generations, the older one is dropped when full."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def trim(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()

    def __missing__(self, key):
        value = self.old[key]
        self[key] = value
        return value

    def lacking(self, keys: set) -> list:
        return [k for k in keys if k not in self and k not in self.old]
