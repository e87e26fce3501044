"""Sinks and file sources: CSV exchange files, replaced tables, append-only history.

CSV options are chosen for a loss-free round trip: quotes doubled, NULL as
``\\N`` (so an empty string stays empty), no whitespace trimming, multi-line
values allowed, microsecond timestamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .versions import publish

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
}


def write_csv(df: DataFrame, path: str, order_by: list[str] | None = None, single_file: bool = True) -> None:
    """SNK5 / SNK6: CSV with a header, in the order of ``order_by``, overwriting.

    Rows are sorted over ranges and written by as many tasks as there are ranges.  With ``single_file`` (the exchange
    boundary) these parts, headerless, are then joined byte by byte, in order, behind one header: no task holds or
    sorts all rows.  Without it each part keeps its own header, and the parts' names follow the order (large exports).
    """
    import uuid

    path = path.rstrip("/")
    out = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by) if order_by else df
    if not single_file:
        out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
        return
    spark = df.sparkSession
    parts = f"{path}.parts-{uuid.uuid4().hex[:8]}"
    out.write.options(**{**CSV_OPTIONS, "header": "false"}).csv(parts)
    fs, folder = _folder(spark, parts)
    names = sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    fresh = f"{path}.new-{uuid.uuid4().hex[:8]}"
    target = fs.create(_folder(spark, f"{fresh}/part-00000.csv")[1], False)
    try:
        quoted = (c.replace('"', '""') for c in df.columns)
        target.write(bytearray((",".join(f'"{c}"' if set(c) & set(',"\n') else c for c in quoted) + "\n").encode()))
        for name in names:  # in the order of the ranges
            source = fs.open(_folder(spark, f"{parts}/{name}")[1])
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, target, 1 << 20, False)
            finally:
                source.close()
    finally:
        target.close()
    fs.delete(folder, True)
    _swap(spark, fresh, path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SRC4: a CSV with header into a declared schema; malformed rows fail the job."""
    return (spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", "true")
            .option("mode", "FAILFAST").csv(path))


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """SNK3: an empty, typed table."""
    return spark.createDataFrame([], schema)


def _folder(spark: SparkSession, path: str):
    """Hadoop file system and path object of a folder, in whatever store it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_if_written(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None if nothing was written there yet; any other trouble raises."""
    fs, p = _folder(spark, path)
    return spark.read.parquet(path) if fs.exists(p) else None


def _swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Let the folder ``fresh`` take the place of ``path``; if that fails the old folder stands where it was."""
    import uuid

    old = f"{path}.old-{uuid.uuid4().hex[:8]}"
    fs, target = _folder(spark, path)
    had = fs.exists(target)
    if had and not fs.rename(target, _folder(spark, old)[1]):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(_folder(spark, fresh)[1], target):
        if had:
            fs.rename(_folder(spark, old)[1], target)
        raise OSError(f"cannot move the new table to {path}")
    if had:
        fs.delete(_folder(spark, old)[1], True)


def replace_table(df: DataFrame, path: str) -> None:
    """SNK2: rebuild a derived table (parquet) that no reader follows while it is written.

    The rows go to a fresh folder first, which then takes the old one's place by renaming: a failed
    write leaves the old table as it was.  Tables with readers are published (``versions.publish``).
    """
    import uuid

    path = path.rstrip("/")
    fresh = f"{path}.new-{uuid.uuid4().hex[:8]}"
    df.write.parquet(fresh)
    _swap(df.sparkSession, fresh, path)


def append_batch(df: DataFrame, path: str, send_date) -> None:
    """SNK4: publish one day's batch of a history; a re-run of the day replaces it, and readers never see half of it."""
    publish(df, path, str(send_date)[:10])


def append_seed_log(seeds: DataFrame, path: str, send_date) -> None:
    """Seed history append (P17): tagged with the run date so a re-run replaces, not repeats."""
    append_batch(seeds.withColumn("send_date", F.lit(str(send_date)[:10])), path, send_date)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC1 / SRC2: a catalog table, optionally catalog- or database-qualified (``cat.db.t``)."""
    return spark.table(name)


def read_query(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """SRC3: the result of a query in an external database, as a DataFrame (JDBC).

    Partitioning options (``partitionColumn``, ``lowerBound``, ``upperBound``,
    ``numPartitions``) spread the read over tasks; credentials come from options.
    """
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()
