"""SNK2, SNK4: published tables.  A run writes its rows to a folder of its own; readers follow a pointer.

``<table>/data/<run>`` holds the folders and ``<table>/current.json`` says, for every part of the table (a day of a history;
one part for a replaced table), which folder is current.  The pointer is written aside and renamed over the old one as the last
step, in one operation of the file system, so a reader sees the table before the run or after it, and a run that
fails half-way leaves the old table.  The pointer has one entry a day; the rows never pass through the driver.
One run at a time publishes to a table.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

WHOLE = "all"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def current(spark: SparkSession, path: str) -> dict[str, str] | None:
    """Part -> folder of the published table at ``path``; None if nothing was published."""
    fs, pointer = _fs(spark, f"{path.rstrip('/')}/current.json")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def publish(df: DataFrame, path: str, part: str = WHOLE) -> None:
    """Make ``df`` the current rows of ``part``; the other parts stay.  Publishing a part again replaces it."""
    run = f"{part}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{path.rstrip('/')}/data/{run}")
    _point(df.sparkSession, path, {part: run})


def publish_parts(df: DataFrame, path: str, part, names: list[str]) -> None:
    """Publish several parts in one write: ``part`` is the column expression that names a row's part, one of ``names``.

    A part of ``names`` without rows is empty from now on.
    """
    run = f"parts-{uuid.uuid4().hex[:12]}"
    folder = f"{path.rstrip('/')}/data/{run}"
    df.withColumn("_part", part).repartition("_part").write.partitionBy("_part").parquet(folder)
    fs, _ = _fs(df.sparkSession, folder)
    there = {n for n in names if fs.exists(_fs(df.sparkSession, f"{folder}/_part={n}")[1])}
    _point(df.sparkSession, path, {n: f"{run}/_part={n}" if n in there else "" for n in names})


def _point(spark: SparkSession, path: str, changed: dict[str, str]) -> None:
    """Switch the pointer: the ``changed`` parts lead to new folders (an empty name: to no rows)."""
    base = path.rstrip("/")
    parts = {**(current(spark, base) or {}), **changed}
    fs, aside = _fs(spark, f"{base}/current-{uuid.uuid4().hex[:12]}.json")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
    finally:
        out.close()
    jvm = spark._jvm
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(aside, jvm.org.apache.hadoop.fs.Path(f"{base}/current.json"), options)


def read_published(spark: SparkSession, path: str, before: str | None = None) -> DataFrame | None:
    """The current rows at ``path`` (with ``before``: of the parts that sort before it); None if there are none."""
    parts = current(spark, path)
    folders = [f"{path.rstrip('/')}/data/{run}" for part, run in sorted((parts or {}).items())
               if run and (before is None or part < before)]
    return spark.read.parquet(*folders) if folders else None


def drop_superseded(spark: SparkSession, path: str) -> int:
    """Delete the folders that the pointer no longer names (to be called when no reader follows an older pointer)."""
    fs, data = _fs(spark, f"{path.rstrip('/')}/data")
    kept, gone = {run.split("/")[0] for run in (current(spark, path) or {}).values()}, 0
    if fs.exists(data):
        for status in fs.listStatus(data):
            if status.getPath().getName() not in kept:
                fs.delete(status.getPath(), True)
                gone += 1
    return gone
