"""One large JSON object read by many tasks.

The file is read as text that is split at commas, which Spark does by byte ranges; a task gets the pieces of its ranges in
order. What a range means depends on the text before it: whether it begins inside a string, and how deep. A range's
effect on both is a small summary, found for either case (a range begins after a comma, so no escape is pending). A
prefix scan over the summaries, one small row for each range, gives every range its state; a second pass cuts the text at the
commas of depth 1. Entries inside a range are whole; what touches a border, at most two pieces a range, is put
together by the entry it belongs to. No task holds more than its batches, and no value more than an entry.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabtext.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE, BACKSLASH, COMMA = 0x22, 0x5C, 0x2C
STEP = np.zeros(256, np.int8)
STEP[[0x7B, 0x5B]] = 1
STEP[[0x7D, 0x5D]] = -1


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value"))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, np.ndarray]]:
    """(file, start, bytes): the pieces of a range that came in one batch, each with the comma after it."""
    for b in batches:
        where = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        values, at = b.column(2).cast(pa.binary()).to_pylist(), 0
        while at < len(where):
            end = at
            while end < len(where) and where[end] == where[at]:
                end += 1
            yield *where[at], np.frombuffer(b",".join([*values[at:end], b""]), np.uint8)
            at = end


def _quotes(text: np.ndarray) -> np.ndarray:
    """Positions of the quotes that no odd run of backslashes escapes."""
    at = np.flatnonzero(text == QUOTE)
    last = np.maximum.accumulate(np.where(text == BACKSLASH, -1, np.arange(len(text))))
    before = np.where(at > 0, last[np.maximum(at - 1, 0)], -1)
    return at[(at - 1 - before) % 2 == 0]


def _inside(text: np.ndarray, quoted: int) -> np.ndarray:
    """For each byte, 1 if it is in a string (an opening quote counts, a closing one does not)."""
    flips = np.zeros(len(text), np.int8)
    flips[_quotes(text)] = 1
    return (np.cumsum(flips, dtype=np.int64) + quoted) % 2


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range: whether it changes between string and not, and its change of depth from either state."""
    found: dict = {}
    for file, start, text in _ranges(batches):
        flip, out, inn = found.get((file, start), (0, 0, 0))
        inside = _inside(text, 0)
        step = STEP[text].astype(np.int64)
        apart, within = int(step[inside == 0].sum()), int(step[inside == 1].sum())
        # the range so far has flipped ``flip`` times: from the other state, the two sums change places
        out, inn = (out + apart, inn + within) if not flip else (out + within, inn + apart)
        found[file, start] = ((flip + int(inside[-1])) % 2, out, inn)
    if found:
        keys, values = list(found), list(found.values())
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int64()),
                                          *[pa.array([v[i] for v in values], pa.int64()) for i in range(3)]],
                                         names=["file", "start", "flip", "d_out", "d_in"])


def _states(rows: list) -> dict:
    """(file, start) -> (in a string, depth) at the range's begin: the prefix scan."""
    out, now = {}, {}
    for r in sorted(rows, key=lambda r: (r["file"], r["start"])):
        quoted, depth = now.get(r["file"], (0, 0))
        out[r["file"], r["start"]] = (quoted, depth)
        now[r["file"]] = ((quoted + r["flip"]) % 2, depth + (r["d_in"] if quoted else r["d_out"]))
    return out


CUT = "file string, start bigint, idx bigint, whole boolean, text string"


def _cut(states: dict):
    """Ranges -> their pieces of entries. Piece 0 goes on with an entry from before; the last piece is open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, idx, held = None, None, 0, []

        def row(whole):
            return (*at, idx, whole and idx > 0, b"".join(held).decode("utf-8", "replace"))

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()))],
                                              names=[c.split()[0] for c in CUT.split(", ")])

        for file, start, text in _ranges(batches):
            rows = []
            if (file, start) != at:
                if at is not None:
                    rows.append(row(False))
                at, state, idx, held = (file, start), states[file, start], 0, []
            inside = _inside(text, state[0])
            step = np.where(inside == 0, STEP[text], 0).astype(np.int64)
            depth = state[1] + np.cumsum(step)
            # an entry begins after the object's brace or a comma of depth 1 and ends before the next comma or the last brace
            mark = (inside == 0) & (((text == COMMA) & (depth == 1)) | ((step == 1) & (depth == 1)) | ((step == -1) & (depth == 0)))
            begin = 0
            for m in np.flatnonzero(mark).tolist():
                held.append(text[begin:m].tobytes())
                rows.append(row(True))
                idx, held, begin = idx + 1, [], m + 1
            held.append(text[begin:].tobytes())
            state = (int(inside[-1]), int(depth[-1]))
            if rows:
                yield batch(rows)
        if at is not None:
            yield batch([row(False)])

    return run


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """(file, entry) for each ``"key": value`` of the JSON objects in the files of ``path``, one object a file."""
    pieces = _pieces(spark, path)
    states = _states(pieces.mapInArrow(_summary, "file string, start bigint, flip bigint, d_out bigint, d_in bigint").collect())  # a row a range
    cut = written(pieces.mapInArrow(_cut(states), CUT))
    ends = cut.groupBy("file", "start").agg(F.max("idx").alias("n")).collect()  # a row a range
    owner, last = [], {}
    for r in sorted(ends, key=lambda r: (r["file"], r["start"])):
        owner.append((r["file"], r["start"], *last.get(r["file"], (-1, 0))))  # the entry that is open when the range begins
        if r["n"] > 0:
            last[r["file"]] = (r["start"], r["n"])
    owners = spark.createDataFrame(owner, "file string, start bigint, o_start bigint, o_idx bigint")
    border = cut.where("NOT whole").join(F.broadcast(owners), ["file", "start"])
    mine = F.col("idx") > 0
    border = border.select("file", F.when(mine, F.col("start")).otherwise(F.col("o_start")).alias("o_start"),
                           F.when(mine, F.col("idx")).otherwise(F.col("o_idx")).alias("o_idx"), "start", "text").where("o_start >= 0")
    joined = border.groupBy("file", "o_start", "o_idx").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "text"))), lambda x: x.text), "").alias("entry"))
    entries = cut.where("whole").select("file", F.col("text").alias("entry")).unionByName(joined.select("file", "entry"))
    return entries.where(F.col("entry").rlike(r"[^\s,]"))  # what follows the last entry is blank, but for the commas put after pieces
