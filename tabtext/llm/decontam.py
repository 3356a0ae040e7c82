"""Benchmark decontamination by a prefix-filtered set join.

Records are the benchmark's windows (``window`` consecutive words; a shorter, non-empty item is one
window). Their elements are word shingles, ordered by rarity: how often the whole corpus holds them.
A window is contained in a document only if all its shingles are, so the prefix that has to be joined
is its rarest shingle alone. Document shingles meet that prefix; the positional bound fixes the one
possible alignment, the length bound asks that the window fits into the document there, and an exact
comparison of the words verifies the containment.

The benchmark goes to the tasks in blocks of at most ``MAX_WINDOWS`` windows (checked), one pass over the
rows for each block; documents never move.
Nulls: a null text has no words; an item with null text has no windows; an item with null id counts as a
hit but not among the items. Repeated rows are treated each on its own.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabtext.llm.common import (HashSet64, doc_chunks, fresh_name, sequence_hashes, ship_by_value, small_batches,
                                text_buffers, word_hashes, worker_cache)
from tabtext.session import cut_lineage

ship_by_value(__name__)

WINDOW = 10
SHINGLE = 3
MAX_WINDOWS = 200_000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    b = np.arange(256)
    word = ((b >= 0x30) & (b <= 0x39)) | ((b >= 0x61) & (b <= 0x7A)) | ((b >= 0x41) & (b <= 0x5A)) | (b >= 0x80)
    lower = np.where((b >= 0x41) & (b <= 0x5A), b + 32, b).astype(np.uint8)
    return word, lower


def words_of(data: np.ndarray, offsets: np.ndarray):
    return word_hashes(data, offsets, *_tables())


class Windows:
    """The windows of one benchmark block: words, shingle lengths, owner item."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int, shingle: int):
        self.window = window
        col = pa.array([t for _, t in items], pa.string())
        data, off = text_buffers(col)
        s, e, h = words_of(data, off)
        doc = np.searchsorted(off, s, "right") - 1
        lower = _tables()[1][data].tobytes()
        n = len(items)
        first = np.searchsorted(doc, np.arange(n))
        count = np.searchsorted(doc, np.arange(n), "right") - first
        self.ids = [i for i, _ in items]
        self.item, self.start, self.length = [], [], []
        for i in range(n):
            c = int(count[i])
            for k in range(max(1, c - window + 1) if c else 0):
                self.item.append(i)
                self.start.append(int(first[i]) + k)
                self.length.append(min(c, window))
        self.hashes = h
        self.words = [lower[a:b] for a, b in zip(s.tolist(), e.tolist())]
        self.shingle = [min(shingle, x) for x in self.length]

    def shingles(self) -> dict[int, np.ndarray]:
        """Distinct shingle hashes by shingle length."""
        out: dict[int, set] = {}
        for w in range(len(self.item)):
            k, a = self.shingle[w], self.start[w]
            hs = sequence_hashes(self.hashes[a:a + self.length[w]], k)
            out.setdefault(k, set()).update(hs.tolist())
        return {k: np.array(sorted(v), np.uint64) for k, v in out.items()}

    def order_by_rarity(self, counts: dict[tuple[int, int], int]) -> None:
        """Windows of equal words become one, with the set of their items. Each hangs on its prefix, its rarest shingle
        (ties: the first): shingle -> (place in the window, window length) -> hash of the whole window -> windows."""
        self.owners: dict[int, set[int]] = {}
        by_len: dict[int, dict] = {}
        first: dict[tuple, int] = {}
        for w in range(len(self.item)):
            k, a, size = self.shingle[w], self.start[w], self.length[w]
            same = first.setdefault((size, b" ".join(self.words[a:a + size])), w)
            self.owners.setdefault(same, set()).add(self.item[w])
            if same != w:
                continue
            hs = sequence_hashes(self.hashes[a:a + size], k).tolist()
            o = min(range(len(hs)), key=lambda i: (counts.get((k, hs[i]), 0), i))
            whole = int(sequence_hashes(self.hashes[a:a + size], size)[0])
            by_len.setdefault(k, {}).setdefault(hs[o], {}).setdefault((o, size), {}).setdefault(whole, []).append(w)
        self.index = {}
        for k, m in by_len.items():
            keys = HashSet64(np.array(list(m), np.uint64))
            self.index[k] = (keys, [m[int(x)] for x in keys.keys])


def _count_pass(windows_by_len: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = {k: HashSet64(v) for k, v in windows_by_len.items()}
        totals = {k: np.zeros(len(s.keys), np.int64) for k, s in sets.items()}
        for b in batches:
            data, off = text_buffers(b.column(0))
            for i, j in doc_chunks(off):
                o = off[i:j + 1] - off[i]
                s, _, h = words_of(data[off[i]:off[j]], o)
                doc = np.searchsorted(o, s, "right") - 1
                for k, t in sets.items():
                    at, num = t.find(sequence_hashes(h, k))
                    ok = doc[at] == doc[at + k - 1]
                    totals[k] += np.bincount(num[ok], minlength=len(t.keys))
        for k, t in sets.items():
            some = np.flatnonzero(totals[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), k), pa.int32()), pa.array(t.keys[some].astype(np.int64), pa.int64()),
                 pa.array(totals[k][some], pa.int64())], names=["k", "h", "n"])

    return run


def _scan(win: Windows, data: np.ndarray, off: np.ndarray):
    """Per document: number of words, hit word numbers, items found."""
    n = len(off) - 1
    n_words, hits, found = np.zeros(n, np.int64), [None] * n, [None] * n
    for i, j in doc_chunks(off):
        o, d = off[i:j + 1] - off[i], data[off[i]:off[j]]
        s, e, h = words_of(d, o)
        first = np.searchsorted(s, o[:-1])
        last = np.append(first[1:], len(s))
        n_words[i:j] = last - first
        doc = np.searchsorted(o, s, "right") - 1
        lower, whole = None, {}
        for k, (keys, groups) in win.index.items():
            at, num = keys.find(sequence_hashes(h, k))
            for p, key in zip(at.tolist(), num.tolist()):
                q = int(doc[p])
                for (o, size), windows in groups[key].items():
                    a = p - o  # position: one alignment
                    if a < first[q] or a + size > last[q]:  # length: the window has to fit
                        continue
                    if size not in whole:
                        whole[size] = sequence_hashes(h, size)
                    for w in windows.get(int(whole[size][a]), ()):
                        if lower is None:
                            lower = _tables()[1][d].tobytes()
                        ws = win.start[w]
                        if any(lower[s[a + x]:e[a + x]] != win.words[ws + x] for x in range(size)):
                            continue
                        if hits[i + q] is None:
                            hits[i + q], found[i + q] = [], set()
                        hits[i + q].append((a - int(first[q]), a - int(first[q]) + size))
                        found[i + q].add(w)
    return n_words, hits, [w and set().union(*(win.owners[x] for x in w)) for w in found]


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


STATE = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.IntegerType())),
                      T.StructField("items", T.ArrayType(T.StringType())), T.StructField("hit", T.BooleanType())])


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
         max_windows: int = MAX_WINDOWS) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all its columns plus n_words, spans (hit word ranges, flat start/end pairs), items
    (distinct ids, as text) and hit; and the names these columns got."""
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")) \
        .where(F.col("t").isNotNull()).distinct()
    # upper bound of the windows: an item has at most one word for two bytes, and a window for each word
    bound = items.agg(F.sum(F.octet_length("t") / 2 + 1)).first()[0] or 0
    blocks = max(1, int(-(-bound // max_windows)))
    names = {f.name: fresh_name(docs, "_bench_" + f.name) for f in STATE}
    base = docs.columns
    at = base.index(text)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(names[f.name], f.dataType) for f in STATE)])
    cur = docs
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        rows = [(r.i, r.t) for r in part.orderBy("i", "t").collect()]
        win = Windows(rows, window, shingle)
        counts: dict[tuple[int, int], int] = {}
        known = win.shingles()
        if known:
            found = docs.select(text).mapInArrow(_count_pass(known), "k int, h bigint, n bigint") \
                .groupBy("k", "h").agg(F.sum("n").alias("n")).collect()  # at most one row a shingle of the block
            counts = {(r.k, r.h % (1 << 64)): r.n for r in found}
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, rows, window, shingle, counts))
        cur = cur.mapInArrow(_mark_pass(shared, at, len(base), list(names.values())), schema)
        if blocks > 1:
            cur = cut_lineage(cur)
    return cur, names


def _mark_pass(shared, at: int, width: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rows, window, shingle, counts = shared.value
        cache = worker_cache()
        if cache.get("windows", (None,))[0] != name:
            win = Windows(rows, window, shingle)
            win.order_by_rarity(counts)
            cache["windows"] = (name, win)
        win = cache["windows"][1]
        for b in batches:
            data, off = text_buffers(b.column(at))
            n_words, hits, found = _scan(win, data, off)
            old = [b.column(width + 1).to_pylist(), b.column(width + 2).to_pylist()] if b.num_columns > width else None
            spans, items, hit = [], [], []
            for r in range(b.num_rows):
                ranges, ids = list(hits[r] or ()), {win.ids[x] for x in found[r] or ()}
                if old is not None:
                    flat = old[0][r]
                    ranges += list(zip(flat[::2], flat[1::2]))
                    ids |= set(old[1][r])
                spans.append([x for ab in _union(ranges) for x in ab])
                items.append(sorted(i for i in ids if i is not None))
                hit.append(bool(ranges))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:width], pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int32())),
                 pa.array(items, pa.list_(pa.string())), pa.array(hit, pa.bool_())],
                names=[*b.schema.names[:width], *names])

    return run


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The digest of ``mark`` for each row of ``docs``."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    m, c = mark(d, benchmark)
    spans = F.col(c["spans"])
    n_hit = F.aggregate(spans, F.struct(F.lit(0).cast("bigint").alias("s"), F.lit(-1).alias("g")),
                        lambda a, x: F.struct((a["s"] + a["g"] * x).alias("s"), (-a["g"]).alias("g")),
                        lambda a: a["s"])
    return m.select("doc_id", F.col(c["n_words"]).alias("n_words"), n_hit.alias("n_hit"),
                    F.size(c["items"]).cast("bigint").alias("n_items"),
                    F.sha2(F.array_join(F.col(c["items"]), ","), 256).alias("items_sha256"),
                    F.col(c["hit"]).alias("contaminated"))


def digest_of(ids) -> str:
    """items_sha256 of a set of item ids (for tests)."""
    return hashlib.sha256(",".join(sorted(str(i) for i in ids)).encode()).hexdigest()
