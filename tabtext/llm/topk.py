"""Exact top-k inner-product search with block-at-a-time pruning.

Components are quantised to floor(64*x). Rows form document-range blocks (``BLOCK`` consecutive ids);
each block keeps the largest and smallest value of each component and a forward index (its rows as a
dense matrix). For a query, the sum over components of the larger product with the block's two extremes
bounds every score in the block. Blocks are visited in descending order of that sum and scored through
their forward index until the bound falls below the query's k-th best score; nothing that could enter the
result is skipped, ties included.

Work is dealt as a grid: blocks form groups of ``GROUP`` blocks, queries form slices of ``SLICE`` queries;
each cell (group, band of slices) is one stream that loads a group's blocks and scores the band's queries
chunk by chunk. The k best of each (query, group) meet in a last window per query, so the shuffle after the
search has k rows for each of them. Null vectors, vectors that hold null, NaN or infinite components, and
rows with null id take no part; vectors of another length than the query's are other spaces and never meet.
Repeated ids are candidates of their own; only rows with the query's own id are left out. Equal query
rows are one query; query rows with one id and different vectors each get their k rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabtext.llm.common import ship_by_value

ship_by_value(__name__)

K = 20
BLOCK = 256
GROUP = 32
SLICE = 256
BAND = 16  # slices to a cell
SCALE = 64


def _vectors(batch_col, dim: int) -> np.ndarray:
    return np.asarray(batch_col.flatten()).reshape(-1, dim)


def _pack(kind: int, size: int):
    """Rows sorted by id within a partition -> one row for each run of ``size`` vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dim: int, rows: list):
            ids = np.array([r[0] for r in rows], np.int64)
            m = np.stack([r[1] for r in rows]).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([kind], pa.int32()), pa.array([int(ids[0])], pa.int64()),
                 pa.array([ids.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())],
                names=["dim", "kind", "first", "ids", "vectors"])

        for b in batches:
            off = b.column(1).offsets.to_numpy()
            flat = np.asarray(b.column(1).values)
            for i, k in enumerate(b.column(0).to_pylist()):
                v = flat[off[i]:off[i + 1]]
                rows = held.setdefault(len(v), [])
                rows.append((k, v))
                if len(rows) == size:
                    yield out(len(v), held.pop(len(v)))
        for dim, rows in sorted(held.items()):
            yield out(dim, rows)

    return run


PACKED = "dim int, kind int, first bigint, ids binary, vectors binary"


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by (score descending, id ascending)."""
    if len(scores) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


class Group:
    """The forward indexes of a group of blocks and their component extremes."""

    def __init__(self, blocks: list[tuple[np.ndarray, np.ndarray]]):
        self.ids = [i for i, _ in blocks]
        # float64 products of these integers are exact below 2**53
        self.rows = [m.astype(np.float64) for _, m in blocks]
        self.exact = max((float(np.abs(m).max(initial=0)) for _, m in blocks), default=0.0)
        self.high = np.stack([m.max(0) for m in self.rows])
        self.low = np.stack([m.min(0) for m in self.rows])

    def search(self, ids: np.ndarray, q: np.ndarray, k: int) -> tuple[list, int]:
        """[(query id, ids, scores)] and the number of (query, block) pairs scored."""
        if self.exact * np.abs(q).max(initial=0) * q.shape[1] >= 2 ** 53:
            return self._search_wide(ids, q, k)
        f = q.astype(np.float64)
        bound = np.maximum(f, 0) @ self.high.T + np.minimum(f, 0) @ self.low.T
        order = np.argsort(-bound, axis=1, kind="stable")
        n, nb = bound.shape
        best_s = [np.zeros(0)] * n
        best_i = [np.zeros(0, np.int64)] * n
        kth = np.full(n, -np.inf)
        scored, alive = 0, np.arange(n)
        for step in range(nb):
            b = order[alive, step]
            go = bound[alive, b] >= kth[alive]
            alive, b = alive[go], b[go]
            if not len(alive):
                break
            for x in np.unique(b):
                who = alive[b == x]
                s = f[who] @ self.rows[x].T
                scored += len(who)
                for r, w in enumerate(who):
                    row, rid = s[r], self.ids[x]
                    hit = np.flatnonzero((row >= kth[w]) & (rid != ids[w]))
                    if not len(hit):
                        continue
                    cs, ci = np.concatenate([best_s[w], row[hit]]), np.concatenate([best_i[w], rid[hit]])
                    at = _best(cs, ci, k)
                    best_s[w], best_i[w] = cs[at], ci[at]
                    if len(at) == k:
                        kth[w] = best_s[w][-1]
        return [(int(ids[w]), best_i[w], best_s[w].astype(np.int64)) for w in range(n)], scored

    def _search_wide(self, ids, q, k):
        """The same result in whole numbers, for components too large for exact floating point."""
        out = []
        for w in range(len(ids)):
            s = np.concatenate([np.array([int(sum(int(a) * int(c) for a, c in zip(q[w], row))) for row in m], object)
                                for m in self.rows])
            i = np.concatenate(self.ids)
            keep = [x for x in range(len(i)) if i[x] != ids[w]]
            keep = sorted(keep, key=lambda x: (-s[x], i[x]))[:k]
            out.append((int(ids[w]), i[keep], np.array([s[x] for x in keep], np.int64)))
        return out, len(ids) * len(self.rows)


def _marks(m: np.ndarray) -> np.ndarray:
    """A 64-bit mark of each query vector, to tell queries with one id apart."""
    return np.array([int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True)
                     for x in m], np.int64)


def _cells(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, blocks, group = None, [], None
        for b in batches:
            for i in range(b.num_rows):
                dim = b.column(0)[i].as_py()
                key = (dim, b.column(5)[i].as_py(), b.column(6)[i].as_py())
                if key != cell:
                    cell, blocks, group = key, [], None
                ids = np.frombuffer(b.column(3)[i].as_py(), np.int64)
                m = np.frombuffer(b.column(4)[i].as_py(), np.int64).reshape(-1, dim)
                if b.column(1)[i].as_py() == 0:
                    blocks.append((ids, m))
                    continue
                if not blocks:
                    continue
                group = group or Group(blocks)
                found, _ = group.search(ids, m, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, [len(f[1]) for f in found]), pa.int64()),
                     pa.array(np.repeat(_marks(m), [len(f[1]) for f in found]), pa.int64()),
                     pa.array(np.concatenate([f[1] for f in found]), pa.int64()),
                     pa.array(np.concatenate([f[2] for f in found]), pa.int64())],
                    names=["query_id", "q", "vec_id", "score"])

    return run


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and floor(64*x) components of the rows that take part."""
    x = F.col(embedding)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return vectors.where(x.isNotNull() & ~bad & F.col(vec_id).isNotNull() & (F.size(x) > 0)) \
        .select(F.col(vec_id).cast("bigint").alias("vec_id"),
                F.transform(x, lambda v: F.floor(F.lit(SCALE) * v.cast("double")).cast("bigint")).alias("v"))


def search(vectors: DataFrame, k: int = K, every: int = 20, vec_id: str = "vec_id", embedding: str = "embedding",
           block: int = BLOCK, group: int = GROUP, band: int = BAND) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every row for each row whose id ``every`` divides."""
    q = quantised(vectors, vec_id, embedding)
    spark = vectors.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = q.repartitionByRange(n, "vec_id").sortWithinPartitions("vec_id")
    blocks = ranged.mapInArrow(_pack(0, block), PACKED)
    queries = q.where(F.col("vec_id") % every == 0).distinct().repartitionByRange(n, "vec_id").sortWithinPartitions("vec_id") \
        .mapInArrow(_pack(1, SLICE), PACKED)
    rows = q.agg(F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    # the grid: rows / (block * group) groups, queries / (SLICE * band) bands
    groups = max(1, -(-rows[0] // (block * group)))
    bands = max(1, -(-rows[1] // (SLICE * band)))
    spread = F.xxhash64("first", "ids")
    g = blocks.withColumn("g", F.pmod(spread, F.lit(groups))) \
        .withColumn("r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bands - 1).cast("bigint"))))
    r = queries.withColumn("g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint")))) \
        .withColumn("r", F.pmod(spread, F.lit(bands)))
    cells = g.unionByName(r).repartition(max(1, min(groups * bands, 16 * n)), "dim", "g", "r") \
        .sortWithinPartitions("dim", "g", "r", "kind", "first")
    found = cells.mapInArrow(_cells(k), "query_id bigint, q bigint, vec_id bigint, score bigint")
    w = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
