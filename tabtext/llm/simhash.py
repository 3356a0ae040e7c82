"""SimHash near-duplicates with a Gray-order hierarchical index.

A fingerprint has 64 bits: bit i is 1 if more than half of the text's shingle hashes (XXH64, seed 42, of
``shingle`` words joined by one space; repeats count) have it. Distinct fingerprints are sorted by their rank
in the reflected Gray code and range-partitioned, so each partition is a run of fingerprints that share many
bits. The index has levels of nodes over that run: partition, blocks of ``NODE * NODE``, blocks of ``NODE``,
fingerprints; a node keeps the mask of bits on which its members agree and their pattern. A probe is
pruned at a node when the differences on the masked bits alone exceed the radius.

Distribution: the partition nodes (at most ``MAX_PARTS``, so of bounded size) go to every task; runs of
``NODE`` fingerprints are sent only to the partitions whose node they cannot rule out, each pair of
partitions in one direction. Inside a task links join a union-find forest, and only forest edges leave it.
Components of these edges come from large-star/small-star rounds. Exact copies have met before, in the
grouping by fingerprint, so their number is immaterial.

Null and empty texts have fingerprint zero and are linked like any other. Null ids keep their fingerprint and get
the smallest non-null id of their component, or null. Repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabtext.llm.common import append_columns, fresh_name, ship_by_value
from tabtext.llm.components import connected_components
from tabtext.session import cut_lineage

ship_by_value(__name__)

SHINGLE = 3
RADIUS = 2
NODE = 32
MAX_PARTS = 2048
GAPS = re.compile(rb"[\x20\x09-\x0D]+")
UPPER = bytes(range(0x41, 0x5B))
FIELD = T.StructType([T.StructField("fp", T.LongType())])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text; shingles are counted in bounded runs."""
    import xxhash

    if not text:
        return 0
    norm = GAPS.sub(b" ", text.encode("utf-8", "surrogatepass").translate(_LOWER)).strip(b" ")
    if not norm:
        return 0
    gaps = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(norm))
    if len(starts) > shingle:
        starts, ends = starts[:len(starts) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 8192):
        h = np.array([digest(norm[a:b], 42) for a, b in zip(starts[at:at + 8192].tolist(), ends[at:at + 8192].tolist())],
                     "<u8")
        total += _column_sums(np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64))
    bits = (2 * total > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def _column_sums(bits: np.ndarray) -> np.ndarray:
    """Column sums of a 0/1 byte matrix: 255 rows at a time fit into bytes, eight bytes to a word."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(bits), 255 * 32):
        part = bits[at:at + 255 * 32]
        cut = len(part) // 255 * 255
        if cut:
            words = np.ascontiguousarray(part[:cut]).view("<u8").reshape(-1, 255, 8).sum(1)
            total += words.view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
        if cut < len(part):
            words = np.ascontiguousarray(part[cut:]).view("<u8").reshape(-1, 8).sum(0)
            total += words.view(np.uint8)
    return total


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> tuple[DataFrame, str]:
    """``docs`` with all its columns plus the fingerprint as a signed bigint; and that column's name."""

    def compute(col: pa.Array) -> list[pa.Array]:
        f = np.array([fingerprint(x.as_py(), shingle) for x in col], np.uint64)
        return [pa.array(f.astype(np.int64), pa.int64())]

    out, names = append_columns(docs, text, FIELD, compute, "_sim_")
    return out, names["fp"]


def gray_rank(fp):
    """Rank of a fingerprint, read as a codeword, in the reflected Gray code; as a signed number that
    sorts like the unsigned rank."""
    r = fp
    for s in (1, 2, 4, 8, 16, 32):
        r = r.bitwiseXOR(F.shiftrightunsigned(r, s))
    return r.bitwiseXOR(F.lit(-(1 << 63)))


def _gray_rank(f: np.ndarray) -> np.ndarray:
    r = f.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def node_of(f: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask of agreed bits and pattern of each run of fingerprints."""
    ones, any_ = np.bitwise_and.reduceat(f, starts), np.bitwise_or.reduceat(f, starts)
    return ones | ~any_, ones


class GrayIndex:
    """The index over one partition's fingerprints."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps[np.argsort(_gray_rank(fps), kind="stable")]
        self.levels = []  # from the leaves' parents upwards: mask, pattern
        width = NODE
        while True:
            self.levels.append(node_of(self.fps, np.arange(0, len(self.fps), width)))
            if len(self.levels[-1][0]) <= NODE:
                break
            width *= NODE
        self.parent = np.arange(len(self.fps))

    def search(self, q: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (probe number, fingerprint number) within the radius: nodes are opened level by level,
        whole groups fall out once their accumulated differences exceed the radius."""
        mask, pattern = self.levels[-1]
        who = np.repeat(np.arange(len(q)), len(mask))
        node = np.tile(np.arange(len(mask)), len(q))
        for depth in range(len(self.levels) - 1, -1, -1):
            mask, pattern = self.levels[depth]
            ok = np.bitwise_count((q[who] ^ pattern[node]) & mask[node]) <= radius
            who, node = who[ok], node[ok]
            below = len(self.levels[depth - 1][0]) if depth else len(self.fps)
            who = np.repeat(who, NODE)
            node = (node[:, None] * NODE + np.arange(NODE)).ravel()
            ok = node < below
            who, node = who[ok], node[ok]
        ok = np.bitwise_count(q[who] ^ self.fps[node]) <= radius
        return who[ok], node[ok]

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if np.array_equal(up, x):
                return x
            self.parent[x] = self.parent[up]
            x = self.parent[x]

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def probe(self, q: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Links of foreign probes: one edge for each probe that has any, after joining what it joins."""
        who, node = self.search(q, radius)
        if not len(who):
            return q[:0], q[:0]
        first = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        lead = np.repeat(node[first], np.diff(np.append(first, len(who))))
        self.union(lead, node)
        return q[who[first]], self.fps[node[first]]

    def join_own(self, radius: int) -> None:
        for at in range(0, len(self.fps), 256):
            who, node = self.search(self.fps[at:at + 256], radius)
            self.union(who + at, node)

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        root = self.roots(np.arange(len(self.fps)))
        at = np.flatnonzero(root != np.arange(len(self.fps)))
        return self.fps[at], self.fps[root[at]]


def _route(nodes: list[tuple[int, int, int]], radius: int):
    """Runs of a partition's fingerprints to the partitions they may have links to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = np.array([n[0] for n in nodes], np.int64)
        mask = np.array([n[1] for n in nodes], np.int64).astype(np.uint64)
        pattern = np.array([n[2] for n in nodes], np.int64).astype(np.uint64)
        for b in batches:
            own = b.column(0).to_numpy()
            f = b.column(1).to_numpy().astype(np.int64).view(np.uint64)
            target, kind, body = [], [], []
            cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(own)]):
                target.append(int(own[a]))
                kind.append(0)
                body.append(f[a:z].tobytes())
                starts = np.arange(a, z, NODE) - a
                m, p = node_of(f[a:z], starts)
                later = np.flatnonzero(part > own[a])
                near = np.bitwise_count((p[:, None] ^ pattern[later]) & m[:, None] & mask[later]) <= radius
                for x in range(len(starts)):
                    run_ = f[a + starts[x]:min(z, a + starts[x] + NODE)]
                    to = later[near[x]]
                    close = np.bitwise_count((run_[:, None] ^ pattern[to]) & mask[to]) <= radius
                    for t in np.flatnonzero(close.any(0)):
                        target.append(int(part[to[t]]))
                        kind.append(1)
                        body.append(run_[close[:, t]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(target, pa.int32()), pa.array(kind, pa.int32()), pa.array(body, pa.binary())],
                names=["target", "kind", "fps"])

    return run


def _link(radius: int):
    """Streams of one partition's own fingerprints followed by foreign probes -> forest edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, index, probes = None, [], None, []

        def edges(a, b):
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64), pa.int64()), pa.array(b.view(np.int64), pa.int64())],
                                              names=["a", "b"])

        def build():
            nonlocal index, own
            if index is None and own:
                index = GrayIndex(np.concatenate(own))
                index.join_own(radius)
                own = []

        def drain():
            nonlocal probes
            build()
            if probes and index is not None:
                q = np.concatenate(probes)
                for x in range(0, len(q), 256):
                    yield edges(*index.probe(q[x:x + 256], radius))
            probes = []

        def close():
            yield from drain()
            if index is not None:
                yield edges(*index.forest())

        for b in batches:
            for i in range(b.num_rows):
                t = b.column(0)[i].as_py()
                if t != at:
                    yield from close()
                    at, own, index, probes = t, [], None, []
                f = np.frombuffer(b.column(2)[i].as_py(), np.uint64)
                if b.column(1)[i].as_py() == 0:
                    own.append(f)
                else:
                    probes.append(f)
                    if len(probes) >= 64:
                        yield from drain()
        yield from close()

    return run


def link_edges(fps: DataFrame, fp: str = "fp", radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) whose components are those of all links between the distinct fingerprints ``fps``."""
    spark = fps.sparkSession
    n = min(MAX_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = fps.select(F.col(fp).alias("f")).withColumn("r", gray_rank(F.col("f"))) \
        .repartitionByRange(n, "r").sortWithinPartitions("r")
    # frozen, since range borders come from a sample
    ranged = cut_lineage(ranged.select(F.spark_partition_id().alias("p"), "f"))
    nodes = [(r.p, r.m, r.o) for r in ranged.groupBy("p").agg(
        F.bit_and("f").alias("o"), F.bit_or("f").alias("y")).select(
        "p", F.col("o").bitwiseOR(F.bitwise_not("y")).alias("m"), "o").orderBy("p").collect()]  # at most MAX_PARTS rows
    routed = ranged.mapInArrow(_route(nodes, radius), "target int, kind int, fps binary")
    return routed.repartition(n, "target").sortWithinPartitions("target", "kind") \
        .mapInArrow(_link(radius), "a bigint, b bigint")


def fingerprint_groups(fps: DataFrame, fp: str = "fp", radius: int = RADIUS) -> DataFrame:
    """(node, root) of the distinct fingerprints that have links; others are groups of their own."""
    return connected_components(link_edges(fps, fp, radius), "a", "b")


def hex16(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint, component_id for every row."""
    d = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    d, fp = with_fingerprint(d, "text", shingle)
    d = cut_lineage(d.select("doc_id", F.col(fp).alias("fp")))
    least = d.groupBy("fp").agg(F.min("doc_id").alias("m"))
    groups = cut_lineage(least.join(fingerprint_groups(least.select("fp"), "fp", radius), least["fp"] == F.col("node"), "left")
                         .select("fp", "m", F.coalesce("root", "fp").alias("root")))
    ids = groups.join(groups.groupBy("root").agg(F.min("m").alias("component_id")), "root").select("fp", "component_id")
    return d.join(ids, "fp").select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group: the smallest doc_id (nulls last), then the smallest row hash."""
    cols = docs.columns
    # two 64-bit hashes of the whole row stand for it while only narrow columns move
    h1, h2 = fresh_name(docs, "_sim_h1"), fresh_name(docs, "_sim_h2")
    keyed = docs.withColumn(h1, F.xxhash64(*[F.col(c) for c in cols])) \
        .withColumn(h2, F.xxhash64(F.lit("row"), *[F.col(c) for c in reversed(cols)]))
    marked, fp = with_fingerprint(keyed, text, shingle)
    order = F.struct(F.col(doc_id).isNull().alias("n"), F.col(doc_id).alias("d"), F.col(h1).alias("h1"), F.col(h2).alias("h2"))
    narrow = cut_lineage(marked.select(F.col(fp).alias("fp"), order.alias("o")))
    least = narrow.groupBy("fp").agg(F.min("o").alias("o"))
    groups = fingerprint_groups(least.select("fp"), "fp", radius)
    first = least.join(groups, least["fp"] == groups["node"], "left").groupBy(F.coalesce("root", "fp").alias("root")) \
        .agg(F.min("o").alias("o")).select(F.col("o.h1").alias(h1), F.col("o.h2").alias(h2))
    whole = fresh_name(docs, "_sim_row")
    return keyed.groupBy(h1, h2).agg(F.first(F.struct(*[F.col(c) for c in cols])).alias(whole)) \
        .join(first, [h1, h2], "left_semi").select(f"{whole}.*")
