"""Ranked lexical search: MaxScore over document segments, with bounds of term pairs.

Scores are whole numbers: a term of weight w = floor(1000 * ln((2N + 2) / (2 df + 1))) that occurs tf times in a
document of length norm m = 10 + (90 n N) div L adds w * ((10**9 tf) div (1000 tf + 8 m)), its impact.

* First pass (``postings``): texts go through in Arrow batches; each batch becomes a segment, i.e. the postings of
  the queries' terms in its documents. Each task also sums up N, L and df of what it read, so the corpus statistics
  come from all documents and only one narrow row a task is aggregated.
* Second pass (``Segment``): with the statistics known, a segment holds impact-ordered facts: the maximum impact of
  every term, and for the planned pairs of terms the intersection list and the largest joint impact in it. Pairs are
  planned once for each query: neighbours in the order of weight, so that rare terms, whose intersections are short or
  empty, meet.
* Query time (``Segment.search``): a pair's bound is the largest of its joint maximum and the two single maxima, never
  above their sum. Pairs and single terms, sorted by bound, split into a non-essential prefix, whose bounds sum up to
  less than the current k-th score, and the essential rest. Documents of the rest are the candidates; they gain the
  prefix's impacts in descending order of bound and drop out once score and remaining bounds fall below the k-th
  score. Bounds equal to it are kept, for the sake of ties.

The k-th scores are carried from segment to segment inside a task. They start from those of a first wave over one
segment of ``WAVE``, which are true lower bounds, so no result is lost. A task gives at most k rows a query; they meet
in two windows (buckets of tasks, then the query).

Queries are handled in blocks of about ``MAX_PAIRS`` (query, term) pairs, so what a task gets stays bounded (one
larger item is a block of its own). Terms are known by their 64-bit hashes; two words of equal hash would count as one.

Defined cases: null text has no terms; an item without terms, or without a document above score 0, gives no rows.
Empty tables give no rows. Equal item rows are one query; rows with one id and different texts are queries of their
own. Null item ids are kept. Repeated documents are documents of their own; a null doc_id ranks behind equal scores.
Texts of any length are read whole. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabtext.llm.common import HashSet64, doc_chunks, ship_by_value, small_batches, text_buffers, word_hashes
from tabtext.session import written

ship_by_value(__name__)

K = 10
WAVE = 32
BUCKETS = 32
MAX_PAIRS = 200_000
# fixed values: bytes of terms ([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F], A-Z lower-cased)
IS_TERM = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)

POSTINGS = ("doc_ids array<bigint>, lengths binary, terms binary, docs binary, tfs binary, "
            "n_docs bigint, n_terms bigint, df_terms array<int>, dfs array<bigint>")


@dataclass
class Queries:
    """A block of queries: term hashes, and for each query its terms' numbers."""

    ids: list
    texts: list
    hashes: np.ndarray
    terms: list[np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple]) -> Queries:
        data, off = text_buffers(pa.array([t for _, t in rows], pa.large_string()))
        starts, _, h = word_hashes(data, off, IS_TERM, LOWER)
        item = np.searchsorted(off, starts, "right") - 1
        keys, number = np.unique(h, return_inverse=True)
        terms = [np.unique(number[item == i]) for i in range(len(rows))]
        return cls([i for i, _ in rows], [t for _, t in rows], keys, terms)

    def plan(self, weight: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Distinct planned pairs (rows of two term numbers), and for each query rows (first, second, pair);
        a term left over has second and pair -1. Neighbours in descending order of weight are pairs."""
        groups, pairs = [], {}
        for t in self.terms:
            t = t[weight[t] > 0]
            t = t[np.lexsort((t, -weight[t]))].tolist()
            g = []
            for i in range(0, len(t) - 1, 2):
                p = (min(t[i:i + 2]), max(t[i:i + 2]))
                g.append((*p, pairs.setdefault(p, len(pairs))))
            if len(t) % 2:
                g.append((t[-1], -1, -1))
            groups.append(np.array(g, np.int64).reshape(-1, 3))
        return np.array(list(pairs), np.int64).reshape(-1, 2), groups


def _postings(hashes: np.ndarray):
    """Texts -> one row for each batch (its segment) and one last row of the task's statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n_terms = HashSet64(hashes), len(hashes)
        df, n_docs, total = np.zeros(n_terms, np.int64), 0, 0
        schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("terms", pa.binary()),
                            ("docs", pa.binary()), ("tfs", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64()),
                            ("df_terms", pa.list_(pa.int32())), ("dfs", pa.list_(pa.int64()))])
        for b in batches:
            data, off = text_buffers(b.column(1))
            lengths, keys, counts = np.zeros(b.num_rows, np.int64), [], []
            for i, j in doc_chunks(off):
                o = off[i:j + 1] - off[i]
                starts, _, h = word_hashes(data[off[i]:off[j]], o, IS_TERM, LOWER)
                doc = np.searchsorted(o, starts, "right") - 1 + i
                lengths += np.bincount(doc, minlength=b.num_rows)
                at, term = known.find(h)
                k, c = np.unique(term * b.num_rows + doc[at], return_counts=True)
                keys.append(k)
                counts.append(c)
            keys = np.concatenate([np.zeros(0, np.int64), *keys])
            counts = np.concatenate([np.zeros(0, np.int64), *counts])
            order = np.argsort(keys, kind="stable")
            term, doc = np.divmod(keys[order], max(1, b.num_rows))
            df += np.bincount(term, minlength=n_terms)
            n_docs += int((lengths > 0).sum())
            total += int(lengths.sum())
            if len(keys):
                yield pa.RecordBatch.from_pylist([{
                    "doc_ids": b.column(0).to_pylist(), "lengths": lengths.tobytes(), "terms": term.astype(np.int32).tobytes(),
                    "docs": doc.astype(np.int32).tobytes(), "tfs": counts[order].astype(np.int64).tobytes()}], schema)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pylist([{"n_docs": n_docs, "n_terms": total, "df_terms": at.tolist(),
                                           "dfs": df[at].tolist()}], schema)

    return run


class Segment:
    """Postings of a run of documents with their impacts and the maxima of terms and planned pairs."""

    def __init__(self, lengths: np.ndarray, terms: np.ndarray, docs: np.ndarray, tfs: np.ndarray, weight: np.ndarray,
                 n_docs: int, n_terms: int, pairs: np.ndarray):
        self.size, self.docs = len(lengths), docs.astype(np.int64)
        norm = 10 + (90 * lengths * n_docs) // max(1, n_terms)
        self.impact = weight[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * norm[docs]))
        self.start = np.searchsorted(terms, np.arange(len(weight) + 1))
        self.high = np.zeros(len(weight), np.int64)
        has = np.flatnonzero(np.diff(self.start))
        if len(has):
            self.high[has] = np.maximum.reduceat(self.impact, self.start[has])
        self.keys = terms.astype(np.int64) * self.size + self.docs
        self.joint = self._intersect(pairs)

    def _intersect(self, pairs: np.ndarray) -> np.ndarray:
        """The largest joint impact in each pair's intersection list (0: no document holds both)."""
        joint = np.zeros(len(pairs), np.int64)
        count = np.diff(self.start)[pairs]
        live = np.flatnonzero((count > 0).all(1))
        if not len(live):
            return joint
        short = pairs[live, np.argmin(count[live], 1)]
        other = pairs[live].sum(1) - short
        n = np.diff(self.start)[short]
        pair = np.repeat(np.arange(len(live)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.start[short][pair]
        key = other[pair] * self.size + self.docs[at]
        to = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        both = self.keys[to] == key
        np.maximum.at(joint, live[pair[both]], self.impact[at[both]] + self.impact[to[both]])
        return joint

    def _gain(self, term: int, docs: np.ndarray) -> np.ndarray:
        """Impact of a term in each of the sorted documents."""
        a, b = self.start[term], self.start[term + 1]
        at = np.minimum(np.searchsorted(self.docs[a:b], docs), b - a - 1) + a
        return np.where(self.docs[at] == docs, self.impact[at], 0)

    def search(self, groups: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents with a score of at least ``least`` (and above 0), their scores, and the number of
        candidates scored."""
        one, two, pair = groups.T
        single = np.where(two >= 0, self.high[two], 0)
        bound = np.maximum(self.high[one], single)
        bound = np.where(pair >= 0, np.maximum(bound, self.joint[pair] if len(self.joint) else 0), bound)
        order = np.argsort(bound, kind="stable")
        order = order[bound[order] > 0]
        below = np.cumsum(bound[order])
        split = int(np.searchsorted(below, least, "left"))  # bounds before it sum up to less than ``least``
        if split == len(order):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        score = np.zeros(self.size, np.int64)
        for g in order[split:]:
            for t in (one[g], two[g]):
                if t >= 0:
                    a, b = self.start[t], self.start[t + 1]
                    score[self.docs[a:b]] += self.impact[a:b]
        docs = np.flatnonzero(score)
        score, scored = score[docs], len(docs)
        for x in range(split - 1, -1, -1):
            alive = score + below[x] >= least
            docs, score = docs[alive], score[alive]
            if not len(docs):
                break
            for t in (one[order[x]], two[order[x]]):
                if t >= 0 and self.start[t + 1] > self.start[t]:
                    score = score + self._gain(t, docs)
        alive = score >= max(1, least)
        return docs[alive], score[alive], scored


class Best:
    """The k best (score descending, id ascending, null ids last) of each query so far."""

    def __init__(self, least: np.ndarray, k: int):
        self.least, self.k = least.copy(), k
        self.held = [[] for _ in least]

    def add(self, q: int, ids: list, scores: np.ndarray) -> None:
        rows = sorted([*self.held[q], *zip((-scores).tolist(), [i is None for i in ids], [i or 0 for i in ids])])[:self.k]
        self.held[q] = rows
        if len(rows) == self.k:
            self.least[q] = max(self.least[q], -rows[-1][0])


def _search(groups: list[np.ndarray], pairs: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int,
            least: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(least, k)
        for b in batches:
            for r in range(b.num_rows):
                ids = b.column(0)[r].as_py()
                arrays = [np.frombuffer(b.column(c)[r].as_py(), d) for c, d in ((1, np.int64), (2, np.int32), (3, np.int32), (4, np.int64))]
                seg = Segment(*arrays, weight, n_docs, n_terms, pairs)
                for q, g in enumerate(groups):
                    docs, scores, _ = seg.search(g, int(best.least[q])) if len(g) else ((), (), 0)
                    if len(docs):
                        if len(docs) > 4 * k:  # ties of the k-th are kept
                            at = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                            docs, scores = docs[at], scores[at]
                        best.add(q, [ids[d] for d in docs], scores)
        rows = [(q, None if gone else i, -s) for q, h in enumerate(best.held) for s, gone, i in h]
        if rows:
            q, i, s = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(i, pa.int64()), pa.array(s, pa.int64())],
                                             names=["q", "doc_id", "score"])

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query: first within buckets of tasks, so no task gets all rows of one query."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = found.withColumn("_b", F.spark_partition_id() % BUCKETS)
    near = Window.partitionBy("q", "_b").orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("rank") <= k) \
        .select("q", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, rows: list[tuple], k: int) -> DataFrame:
    spark, q = docs.sparkSession, Queries.of(rows)
    index = written(docs.mapInArrow(_postings(q.hashes), POSTINGS))
    totals = index.where("n_docs IS NOT NULL")
    n_docs, n_terms = (x or 0 for x in totals.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    dfs = totals.select(F.explode(F.arrays_zip("df_terms", "dfs")).alias("x")).groupBy("x.df_terms").agg(F.sum("x.dfs").alias("df"))
    df = np.zeros(len(q.hashes), np.int64)
    for t, n in dfs.collect():  # a row for each term of the block
        df[t] = n
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) if x else 0 for x in df], np.int64)
    pairs, groups = q.plan(weight)
    segments = index.where("n_docs IS NULL").select("doc_ids", "lengths", "terms", "docs", "tfs")
    schema = "q int, doc_id bigint, score bigint"

    def wave(of: DataFrame, least: np.ndarray) -> DataFrame:
        return _ranked(of.mapInArrow(_search(groups, pairs, weight, n_docs, n_terms, least, k), schema), k)

    least = np.zeros(len(rows), np.int64)
    first = wave(segments.where(F.pmod(F.xxhash64("lengths"), F.lit(WAVE)) == 0), least)
    for i, s in first.where(F.col("rank") == k).select("q", "score").collect():  # a row for each query of the block
        least[i] = s
    names = spark.createDataFrame([(i, x) for i, x in enumerate(q.ids)], "q int, item_id bigint")
    return wave(segments, least).join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", max_pairs: int = MAX_PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of each item."""
    spark = docs.sparkSession
    small_batches(spark)
    d = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    q = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).alias("text")) \
        .where("text IS NOT NULL").distinct()
    size = F.size(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    q = q.withColumn("size", size)
    total = q.agg(F.sum("size")).first()[0] or 0
    blocks = -(-total // max_pairs)
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for b in range(blocks):
        rows = [(r[0], r[1]) for r in q.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
                .orderBy("item_id", "text").select("item_id", "text").collect()]  # about max_pairs words
        if rows:
            out = out.unionByName(_search_block(d, rows, k)) if blocks > 1 else _search_block(d, rows, k)
    return out
