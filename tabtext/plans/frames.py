"""Composed frames shared by queries and the end-to-end workflow: the
pipeline's ingest + join stages over the stand-in inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabtext.operators.joins import merge_modalities
from tabtext.sources import standins as si
from tabtext.sources.files import clean_modality_frame

MODALITIES = [f"m{k}" for k in range(si.N_MODALITIES)]
RAD_COLS = [f"m{k}__rad_{i}" for k in range(si.N_MODALITIES) for i in range(si.BLOCK)]


def modality_frames(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Cleaned per-modality frames (S6 body on each stand-in file)."""
    out = []
    for k in range(si.N_MODALITIES):
        f = clean_modality_frame(si.radiomics_raw(spark, sf_dir, k), f"m{k}")
        if f is not None:
            out.append(f)
    return out


def radiomics_merged(spark: SparkSession, sf_dir: str, strategy: str = "union") -> DataFrame:
    """All modalities merged on case_id (full outer semantics)."""
    return merge_modalities(modality_frames(spark, sf_dir), how="full", strategy=strategy)


def case_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases LEFT JOIN merged radiomics."""
    return si.cases(spark, sf_dir).join(radiomics_merged(spark, sf_dir), "case_id", "left")


def radiomics_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Radiomics cases with their own labels, LEFT JOIN merged radiomics."""
    return si.radiomics_labels(spark, sf_dir).join(radiomics_merged(spark, sf_dir), "case_id", "left")
