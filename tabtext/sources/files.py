"""Optional CSV inputs, per-modality radiomics scan, vector tables, sinks
(S5-S10)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabtext.operators.schema import drop_exact, prefix_columns, truncated_id


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop FS of ``path`` (works for local and
    distributed file systems)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) or len(fs.globStatus(p) or []) > 0


def read_optional_csv(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """CSV with header; absent file -> None (not an error)."""
    if not path_exists(spark, path):
        return None
    r = spark.read.option("header", True).option("encoding", "UTF-8")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


RAD_DROP = ["sex", "age", "modality"]


def clean_modality_frame(df: DataFrame, modality: str, key: str = "case_id",
                         feature_prefix: str = "rad_") -> DataFrame | None:
    """Body of one radiomics file (P1, P3-P7): drop sex/age/modality (exact
    names), keep key + ``rad_*``, numeric key with bad text -> null, drop null
    keys, truncate to bigint, prefix features with ``{modality}__``.
    None when the frame has no key or no feature columns."""
    if key not in df.columns:
        return None
    df = drop_exact(df, RAD_DROP)
    feats = [c for c in df.columns if c.startswith(feature_prefix)]
    if not feats:
        return None
    out = df.select(truncated_id(key).alias(key), *[F.expr(f"try_cast(`{c}` AS DOUBLE)").alias(c) for c in feats])
    out = out.filter(F.col(key).isNotNull())
    return prefix_columns(out, feats, f"{modality}__")


def list_modality_files(spark: SparkSession, directory: str, split: str) -> list[tuple[str, str]]:
    """Sorted (modality, path) for ``*_radiomics_{split}.csv``.
    The folder is listed through its Hadoop file system (a handful of names);
    an absent folder has no files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []
    pat = re.compile(rf"^(.*)_radiomics_{re.escape(split)}\.csv$")
    named = sorted((p.getName(), p.toString()) for p in found if pat.match(p.getName()))
    return [(pat.match(name).group(1), full) for name, full in named]


def read_radiomics_split(spark: SparkSession, directory: str, split: str,
                         how: str = "full") -> DataFrame | None:
    """Every modality file of a split, cleaned and merged on case_id.
    Files without key or features are skipped; no files -> None. Spark's CSV
    reader strips the UTF-8 BOM."""
    from tabtext.operators.joins import merge_modalities

    frames = []
    for modality, path in list_modality_files(spark, directory, split):
        raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
        clean = clean_modality_frame(raw, modality)
        if clean is not None:
            frames.append(clean)
    if not frames:
        return None
    return merge_modalities(frames, how=how)


def submission(df: DataFrame, key: str = "case_id", pred: str = "pred",
               target: str = "Overall_class") -> DataFrame:
    """Key rendered as string plus the predicted label column."""
    return df.select(F.col(key).cast("string").alias("case_id"), F.col(pred).alias(target))


def write_csv(df: DataFrame, directory: str, single_file: bool = False) -> str:
    """CSV with header, overwrite; parts as partitioned. ``single_file``
    is for small outputs: one task writes them, after a shuffle, so the work
    before stays parallel."""
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(directory)
    return directory
