"""Training corpus pipeline: documents in five stages to packed token rows.

Each stage is (name, function of (spark, docs, sf_dir)); a stage gets all rows its predecessor kept. All but
the last return the columns of documents. Nulls, empty texts, repeated rows and extra columns are handled
as the operators' docstrings say; an empty table stays empty through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabtext.llm import decontam, langid, mixing, packing, simhash
from tabtext.llm.registry import table
from tabtext.session import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the identifier, trained on this stage's labelled rows, could tell; texts
    that are null or have no letters are rejected."""
    out, c = langid.annotate(docs, langid.fit(docs))
    return out.where(F.col(c["lang_pred"]) != "und").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    out, c = decontam.mark(docs, table(spark, sf_dir, "benchmark"))
    return out.where(~F.col(c["hit"])).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix, each source at its target weight."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token rows, in the order of the mix as its files hold it; every token of every document is in exactly
    one of them."""
    return packing.pack(packing.in_file_order(docs))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mix), ("token_output", token_output)]

#: language identification is learned from the rows and SQL cannot express it; tests compare stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
