"""Report features over a Structured Streaming source.

The report statistics, keyword flags and interactions are stateless
projections, so the same functions apply to ``readStream`` DataFrames; a
fitted TF-IDF model (vocabulary + idf) is a per-row map as well. The query
checkpoint goes under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tabtext.functions import text as tx
from tabtext.operators.tfidf import TfidfModel
from tabtext.session import ensure_checkpoint_dir


def stream_report_features(stream: DataFrame, col: str = "report", model: TfidfModel | None = None,
                           out_vec: str = "word") -> DataFrame:
    """The report feature block (and optionally a fitted TF-IDF block) on a
    streaming DataFrame."""
    if model is not None:
        stream = stream.withColumn("_raw_report", stream[col])
    df = tx.add_report_features(stream, col)
    if model is not None:
        df = model.transform(df, "_raw_report", out_vec).drop("_raw_report")
    return df


def start(spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None,
          trigger_once: bool = True) -> StreamingQuery:
    """Write a streaming frame (append) with its checkpoint in the shared
    checkpoint folder. ``fmt='memory'`` serves tests (query name = table)."""
    ck = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    w = df.writeStream.outputMode("append").option("checkpointLocation", ck).queryName(name)
    w = w.trigger(availableNow=True) if trigger_once else w
    if fmt == "memory":
        return w.format("memory").start()
    return w.format(fmt).option("path", path).start()
