"""Token-id output: best-fit-decreasing packing into fixed-length rows.

Texts become token ids ended by the end-of-document id. A document longer than a row is split into
full rows plus a remainder, so no id is lost; remainders and short documents are packed best-fit
decreasing: longest first, each into the open row with the least room that still holds it. The row is
found by a segment tree over capacities (leaf c: open rows with c free places).

Packing runs over stretches of the input of about ``stretch`` tokens inside each scan partition: memory
is bounded, nothing is shuffled, a hot key plays no part, and rows keep the order of a mixed input up to
one stretch. Each output row holds the ids padded to ``length`` with the end-of-document id, the
cumulative segment lengths (first 0; the last is the number of real ids) and positions restarting at 0 in
each segment.
Nulls and empty texts give one end-of-document id; a null doc_id stays null in ``doc_ids``; repeated rows
are packed each on its own; extra columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabtext.llm import tokens
from tabtext.llm.common import fresh_name, ship_by_value, small_batches

ship_by_value(__name__)

LENGTH = 2048
STRETCH = 1 << 21

SCHEMA = ("row_id bigint, doc_ids array<bigint>, parts array<int>, n_tokens int, cu_seqlens array<int>, "
          "input_ids binary, position_ids binary")


class CapacityTree:
    """Segment tree over capacities 0..size: smallest capacity >= c that some open row has."""

    def __init__(self, size: int):
        self.leaves = 1 << int(size).bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, change: int) -> None:
        i = self.leaves + capacity
        while i:
            self.count[i] += change
            i >>= 1

    def at_least(self, c: int) -> int | None:
        i = self.leaves + c
        if self.count[i]:
            return c
        while i > 1:
            if not i & 1 and self.count[i + 1]:  # a left child whose right sibling has open rows
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Item numbers by row; sizes are 1 to ``capacity``. Ties: earlier items, and rows that reached
    the same room earlier, first."""
    tree, free, rows = CapacityTree(capacity), {}, []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        need = sizes[i]
        c = tree.at_least(need)
        if c is None:
            rows.append([])
            r, left = len(rows) - 1, capacity
        else:
            r, left = free[c].popleft(), c
            tree.add(c, -1)
        rows[r].append(i)
        if left > need:
            free.setdefault(left - need, deque()).append(r)
            tree.add(left - need, 1)
    return rows


def _emit(segments, length: int, eod: int, dtype: str, base: int):
    """Arrow batches of packed rows; ``segments``: (doc_id, part, ids)."""
    full = [i for i, x in enumerate(segments) if len(x[2]) == length]
    rest = [i for i, x in enumerate(segments) if len(x[2]) < length]
    rows = [[i] for i in full] + [[rest[k] for k in r] for r in best_fit_decreasing([len(segments[i][2]) for i in rest], length)]
    rows.sort(key=min)  # in the order of their first documents
    for at in range(0, len(rows), 1024):
        part = rows[at:at + 1024]
        ids, pos, cum = [], [], []
        for r in part:
            m, p = np.full(length, eod, dtype), np.zeros(length, dtype)
            c = [0]
            for i in r:
                x = segments[i][2]
                m[c[-1]:c[-1] + len(x)] = x
                p[c[-1]:c[-1] + len(x)] = np.arange(len(x))
                c.append(c[-1] + len(x))
            p[c[-1]:] = np.arange(length - c[-1])
            ids.append(m.tobytes())
            pos.append(p.tobytes())
            cum.append(c)
        yield pa.RecordBatch.from_arrays(
            [pa.array([base + at + k for k in range(len(part))], pa.int64()),
             pa.array([[segments[i][0] for i in r] for r in part], pa.list_(pa.int64())),
             pa.array([[segments[i][1] for i in r] for r in part], pa.list_(pa.int32())),
             pa.array([c[-1] for c in cum], pa.int32()), pa.array(cum, pa.list_(pa.int32())),
             pa.array(ids, pa.binary()), pa.array(pos, pa.binary())],
            names=["row_id", "doc_ids", "parts", "n_tokens", "cu_seqlens", "input_ids", "position_ids"])


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
         vocabulary: str | None = None, stretch: int = STRETCH) -> DataFrame:
    """Packed rows of ``docs``. ``row_id`` is unique: partition * 2**33 + row. ``input_ids`` and
    ``position_ids`` are little-endian matrices rows of 16-bit (vocabularies under 65,536 ids) or 32-bit numbers."""
    small_batches(docs.sparkSession)
    voc = tokens.load(docs.sparkSession, vocabulary)
    src = docs.select(F.col(doc_id).cast("bigint").alias("d"), F.col(text).alias("t"),
                      F.spark_partition_id().alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = tokens.Vocabulary(voc.value)
        dtype = "<u2" if max(v.eod, length) < 1 << 16 else "<u4"
        held, size, done, pid = [], 0, 0, 0

        def flush():
            nonlocal held, size, done
            for out in _emit(held, length, v.eod, dtype, (pid << 33) + done):
                done += out.num_rows
                yield out
            held, size = [], 0

        for b in batches:
            if b.num_rows:
                pid = b.column(2)[0].as_py()
            ids = b.column(0).to_pylist()
            for r in range(b.num_rows):
                x = np.append(v.encode(b.column(1)[r].as_py()), np.array([v.eod], v.dtype)).astype(dtype)
                for k in range(0, len(x), length):
                    held.append((ids[r], k // length, x[k:k + length]))
                size += len(x)
                if size >= stretch:
                    yield from flush()
        if held:
            yield from flush()

    return src.mapInArrow(run, SCHEMA)


def in_file_order(docs: DataFrame) -> DataFrame:
    """Rows of a Parquet table in the order they were written: by file name (its partition), then row. A frame that is
    no table read from files keeps the order it has."""
    f, r = fresh_name(docs, "_file"), fresh_name(docs, "_row")
    try:
        x = docs.select("*", F.col("_metadata.file_name").alias(f), F.col("_metadata.row_index").alias(r))
    except AnalysisException:
        return docs
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return x.repartitionByRange(n, f, r).sortWithinPartitions(f, r).drop(f, r)


def write(packed: DataFrame, path: str) -> None:
    """Store packed rows as Parquet; Spark's committer makes the write safe against lost executors."""
    packed.write.parquet(path)


def matrix(rows, length: int = LENGTH, dtype: str = "<u2") -> np.ndarray:
    """Id matrix of collected rows (a bounded number of them)."""
    return np.stack([np.frombuffer(bytes(r.input_ids), dtype) for r in rows]) if rows else np.zeros((0, length), dtype)
