"""Token counts of flat token files by a separator scan.

A flat file is a sequence of little-endian 16- or 32-bit ids without any index; each document's ids are
followed by the end-of-document id. Files are read in blocks of ``BLOCK`` ids whose borders ignore documents.
Inside a block one vectorised comparison finds the separators. A prefix scan over the blocks of a file
(one narrow row each) then gives every block the number of separators before it and the place of the last
one, which stitches documents over block borders, however many blocks they span.

Files are opened through pyarrow's file systems by URI, so they may be local, HDFS or object storage.
``write_flat`` makes such files from texts: one for each task, moved into place when complete, so a repeated
task replaces its file by the same bytes. Null and empty texts are documents of no tokens; repeated rows are
documents of their own; ids after the last separator form a last, unended document; empty files hold none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabtext.llm import tokens
from tabtext.llm.common import ship_by_value, small_batches
from tabtext.session import cut_lineage, ensure_checkpoint_dir

ship_by_value(__name__)

BLOCK = 1 << 21


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_flat(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text",
               vocabulary: str | None = None) -> DataFrame:
    """Write the flat files; returns (file, size in ids, ordinal, doc_id), one row per document in file order."""
    small_batches(docs.sparkSession)
    voc = tokens.load(docs.sparkSession, vocabulary)
    src = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                      F.spark_partition_id().alias("file"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v, out, name, seen, fs = tokens.Vocabulary(voc.value), None, None, 0, None
        tail = np.array([v.eod], v.dtype)
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                fs, root = _filesystem(folder)
                fs.create_dir(root, recursive=True)
                name = f"{root}/tokens-{b.column(2)[0].as_py():06d}.bin"
                temp = f"{name}.{TaskContext.get().taskAttemptId()}.tmp"
                out = fs.open_output_stream(temp)
            for r in range(b.num_rows):
                out.write(v.encode(b.column(1)[r].as_py()).astype(v.dtype).tobytes() + tail.tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(2), pa.array(range(seen, seen + b.num_rows), pa.int64()), b.column(0)],
                names=["file", "ordinal", "doc_id"])
            seen += b.num_rows
        if out is not None:
            out.close()
            fs.move(temp, name)

    return src.mapInArrow(run, "file int, ordinal bigint, doc_id bigint")


def blocks_of(spark: SparkSession, folder: str, width: int, block: int = BLOCK) -> DataFrame:
    """(file, block, offset, n) of every block of the folder's files, from their names and sizes alone."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    sizes = [(s.getPath().toString(), s.getLen()) for s in (fs.listStatus(path) if fs.exists(path) else [])
             if s.getPath().getName().endswith(".bin")]
    bad = [p for p, n in sizes if n % width]
    if bad:
        raise ValueError(f"size is no multiple of {width} bytes: {bad[:5]}")
    files = spark.createDataFrame([(p, n // width) for p, n in sizes], "path string, n bigint")
    name = F.regexp_extract("path", r"(\d+)\.bin$", 1).cast("int")
    return files.where(F.col("n") > 0).select(name.alias("file"), "path", "n", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / block))).alias("block")) \
        .select("file", "path", "block", (F.col("block") * block).alias("offset"),
                F.least(F.lit(block), F.col("n") - F.col("block") * block).alias("n"))


def _scan(eod: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.dtype(dtype).itemsize
        for b in batches:
            for path, file, block, offset, n in zip(*(c.to_pylist() for c in b.columns)):
                fs, p = _filesystem(path)
                with fs.open_input_file(p) as f:
                    f.seek(offset * width)
                    ids = np.frombuffer(f.read(n * width), dtype)
                if len(ids) != n:
                    raise OSError(f"{path}: {len(ids)} of {n} ids at {offset}")
                ends = np.flatnonzero(ids == eod).astype(np.int64) + offset
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file], pa.int32()), pa.array([block], pa.int64()), pa.array([offset + n], pa.int64()),
                     pa.array([len(ends)], pa.int64()), pa.array([int(ends[-1]) if len(ends) else None], pa.int64()),
                     pa.array([ends.tobytes()], pa.binary())],
                    names=["file", "block", "stop", "n_ends", "last_end", "ends"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that end in a block, given where the one that is open at its start began."""
    for b in batches:
        for r in range(b.num_rows):
            file, before, begin, ends, rest = (b.column(i)[r].as_py() for i in range(5))
            e = np.frombuffer(ends, np.int64)
            start = np.append(begin, e + 1)
            if rest is None:
                start = start[:-1]
            else:
                e = np.append(e, rest)
            n = len(e)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, file, np.int32)), pa.array(before + np.arange(n)), pa.array(start[:n]),
                 pa.array(e - start[:n])], names=["file", "ordinal", "token_start", "n_tokens"])


def count_tokens(spark: SparkSession, folder: str, eod: int, dtype: str = "<u2", block: int = BLOCK) -> DataFrame:
    """(file, ordinal, token_start, n_tokens) of every document in the flat files of ``folder``."""
    blocks = blocks_of(spark, folder, np.dtype(dtype).itemsize, block)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = blocks.select("path", "file", "block", "offset", "n").repartition(n, "file", "block") \
        .mapInArrow(_scan(eod, dtype), "file int, block bigint, stop bigint, n_ends bigint, last_end bigint, ends binary")
    w = Window.partitionBy("file").orderBy("block")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    scanned = found.withColumn("before", F.coalesce(F.sum("n_ends").over(past), F.lit(0))) \
        .withColumn("begin", F.coalesce(F.max("last_end").over(past) + 1, F.lit(0))) \
        .withColumn("is_last", F.lead("block").over(w).isNull())
    # only the last block of a file may leave a document without its separator
    here = F.coalesce(F.col("last_end") + 1, F.col("begin"))
    rest = F.when(F.col("is_last") & (here < F.col("stop")), F.col("stop"))
    return scanned.select("file", "before", "begin", "ends", rest.alias("rest")) \
        .mapInArrow(_cut, "file int, ordinal bigint, token_start bigint, n_tokens bigint")


def document_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
                    block: int = BLOCK) -> DataFrame:
    """doc_id, file, ordinal, token_start, n_tokens: write flat files to the shared folder, scan them, and
    give each document found its id by its ordinal."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/flat-{uuid.uuid4().hex}"
    voc = tokens.read(vocabulary)
    order = cut_lineage(write_flat(docs, folder, doc_id, text, vocabulary))
    return count_tokens(spark, folder, voc.eod, voc.dtype, block).join(order.hint("shuffle_merge"), ["file", "ordinal"]) \
        .select("doc_id", "file", "ordinal", "token_start", "n_tokens")
