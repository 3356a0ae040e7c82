"""Spark session and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "tabtext",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build a local one with sane defaults.

    On a cluster the session already exists (spark-submit), so every setting
    below is only applied when we create the session ourselves.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.driver.memory", os.environ.get("TABTEXT_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset
    (local runs and tests) point it at a fresh scratch folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset; a cluster needs a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tabtext-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and return a
    DataFrame reading it back: survives executor loss, bounds plan size for
    driver loops and freezes any data-dependent physical layout."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the checkpoint folder and return a DataFrame reading it back: like
    ``cut_lineage``, but compressed, and readable by column."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the table that ``written`` made for ``df``, once nothing reads it any more. Other paths stay."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        name = folder.rsplit("/", 1)[1]
        if name.startswith("written-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
