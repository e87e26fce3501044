"""SparkSession helpers.

The cluster owns ``spark.checkpoint.dir``; we only fill it in when it is unset
(local tests).  The UI stays off: no extra server or port is opened.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


_STEP_PATHS: list[str] = []  # step tables of this process, newest last


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tallyrec") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TALLYREC_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a scratch one only if none is configured."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: step tables must survive executor loss")
        path = tempfile.mkdtemp(prefix="tallyrec-ckpt-")  # local runs and tests only
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (never a machine-local temp dir)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tallyrec-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut lineage at a step boundary: a Parquet table in the shared checkpoint folder, read back.

    The original jobs hand persistent tables from step to step; this plays the
    same role, keeps later plans small, and survives the loss of executors
    (unlike ``localCheckpoint``).  Later steps read only the columns they use
    and push their filters into the scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    _STEP_PATHS.append(path)
    return spark.read.schema(df.schema).parquet(path)


def step_tables() -> int:
    """How many step tables this process has written and not yet dropped."""
    return len(_STEP_PATHS)


def drop_step_tables(spark: SparkSession, since: int = 0) -> None:
    """Delete the step tables written after the first ``since`` ones (see ``step_tables``)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    while len(_STEP_PATHS) > since:
        path = jvm.org.apache.hadoop.fs.Path(_STEP_PATHS.pop())
        path.getFileSystem(conf).delete(path, True)
