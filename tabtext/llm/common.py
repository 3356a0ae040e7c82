"""Helpers shared by the operators: Arrow text access, vectorised word hashing,
per-worker caches and row-preserving ``mapInArrow`` columns."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ship_by_value(module: str) -> None:
    """Workers get the module's code with the task, so they need not import the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship_by_value(__name__)

SEGMENT = 1 << 20  # bytes handled at once by the vectorised kernels
BATCH_BYTES = 8 << 20


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker (functions shipped by value do not)."""
    m = sys.modules.setdefault("_tabtext_llm_cache", types.ModuleType("_tabtext_llm_cache"))
    return m.__dict__.setdefault("items", {})


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most about BATCH_BYTES (a smaller setting stays), so that JVM vectors and
    workers hold little even where rows are long. Holds for the session, since plans run later."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < _bytes(spark.conf.get(key)) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def _bytes(setting: str) -> int:
    m = re.fullmatch(r"(-?\d+)([bkmgt]?)b?", setting.strip().lower())
    return int(m[1]) * 1024 ** "bkmgt".index(m[2] or "b") if m else -1


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n+1 offsets of an Arrow string column, without copying; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    o = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0]:o[-1]], o - o[0]


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def powers(n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept per worker."""
    cache = worker_cache()
    have = cache.get(("pow", base))
    if have is None or len(have) < n:
        have = np.full(max(n, 4096), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        cache[("pow", base)] = have
    return have[:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray,
                lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (maximal runs of ``is_word`` bytes inside one document) of documents laid end to end:
    start, end and 64-bit hash of the lower-cased bytes. Works in segments cut between words,
    so the wide temporaries stay bounded for a document of any length."""
    w = is_word[data]
    before, after = np.empty_like(w), np.empty_like(w)
    if len(w) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64)
    before[0], before[1:] = False, w[:-1]
    after[-1], after[:-1] = False, w[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    after[inner - 1] = False
    starts, ends = np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1
    del before, after
    out = np.empty(len(starts), np.uint64)
    pw, code = powers(4096), lower.astype(np.uint64) + np.uint64(1)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
        s, e = starts[i:j], ends[i:j]
        lens = e - s
        base = np.concatenate(([0], np.cumsum(lens)[:-1]))
        inside = np.arange(int(lens.sum())) - np.repeat(base, lens)
        b = code.take(data[s[0]:e[-1]][w[s[0]:e[-1]]])  # the bytes between are no words
        b *= pw.take(inside) if lens.max() <= 4096 else pw[inside & 4095] + (inside >> 12).astype(np.uint64)
        out[i:j] = mix64(np.add.reduceat(b, base) + lens.astype(np.uint64))
        i = j
    return starts, ends, out


def sequence_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    pw = powers(k, 0xC2B2AE3D27D4EB4F)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc += h[j:j + n] * pw[j]
    return mix64(acc)


class HashSet64:
    """Sorted 64-bit keys behind a 2**20-entry bit table: position of each query key, or -1."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes into ``h`` that hold a known key, and the key's number."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.table[(h >> np.uint64(44)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        ok = self.keys[k] == h[at]
        return at[ok], k[ok]


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has, in any letter case."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def append_columns(df: DataFrame, source: str, fields: T.StructType,
                   compute: Callable[[pa.Array], list[pa.Array]], prefix: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` plus columns that ``compute`` makes, batch by batch, from column ``source``. Rows keep
    all their columns; no join and no row identity is needed. Returns the frame and the new names
    (``prefix`` + field, lengthened when taken)."""
    small_batches(df.sparkSession)
    names = {f.name: fresh_name(df, prefix + f.name) for f in fields}
    schema = T.StructType([*df.schema.fields, *(T.StructField(names[f.name], f.dataType) for f in fields)])
    at = df.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            extra = compute(b.column(at))
            yield pa.RecordBatch.from_arrays([*b.columns, *extra], names=[*b.schema.names, *names.values()])

    return df.mapInArrow(run, schema), names


def doc_chunks(offsets: np.ndarray, size: int = 4 * SEGMENT) -> Iterator[tuple[int, int]]:
    """Runs of consecutive documents of about ``size`` bytes (a longer document is a run of its own)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)

