"""Prefix trie of conversations: union-find over LCP edges of sorted neighbours.

Turns become 16-byte digests of (role, text) with the text's length; no text moves after that. A conversation is the
sequence of its digests. Equal sequences are grouped first (``grouped``), so a group of copies of any size is one row;
the ids of such a group are joined in sorted pieces and hashed as a stream.

Distinct sequences are range-partitioned and sorted; each partition is cut into runs of at most ``RUN`` sequences or
``RUN_BYTES``. Inside a run (``forest``) neighbours are linked by edges whose depth is the length of their common
prefix. Edges are taken in descending depth; union-find merges the two components, and every merge makes, or adds to,
the branching node of that depth. Nodes between a branching node and the one above it have the same members and come
out as a chain. So a run's forest costs its turns plus its edges.

Across run borders: a node that holds the first (last) sequence of a run and is no deeper than the common prefix with
the run before (after) is shared between runs. Runs give such nodes as parts, one for each depth of their left and
right border path, contracted to the sums of what is closed below. Parts of one prefix meet in an aggregation
(``merge_borders``); the sums over the shared subtree come from running sums along the border paths, where every
shared node counts on one path only. All of it is joins and windows on (run, border) or prefix keys; the rows are
border paths only, two for each run. What the driver gets is two small numbers for each run.

Defined cases: turns are ordered by turn, null first, equal turns by the digest of role and text; null role or text is
empty. Rows with null conv_id belong to no conversation and are left out. Repeated rows are turns of their own. An
empty table has no nodes; a conversation without turns is a member of the root and ends there. ``c % 100`` has the sign of
c, so -5 is rebuilt from 0. Extra columns are not read. Texts of any length are read whole. A conversation's digests
form one row: 20 bytes a turn, so a single conversation may have up to about 100 million turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabtext.llm.common import ship_by_value
from tabtext.operators.ranking import row_number_within
from tabtext.session import cut_lineage, written

ship_by_value(__name__)

# fixed values: how conversations are rebuilt
FAMILY = 100
HEADS = 6
RUN = 20_000
RUN_BYTES = 8 << 20
PIECE = 65_536  # ids to a piece of a group's list
WIDTH = 16


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """conv_id, rn (1-based place in the conversation), d (digest of role and text), n (code points of text)."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    x = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"),
        F.md5(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t)).alias("d"),
        F.char_length(t).cast("bigint").alias("n"))
    return row_number_within(x, ["conv_id"], [F.col("turn").asc_nulls_first(), "d"]).drop("turn")


def rebuilt(numbered: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """conv_id, key (digests in order), lens (code points in order), sd (digest of the sequence): the first
    h = crc32(conv_id) % heads turns come from conversation c - c % family, the rest are its own beyond the first h."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h")
    convs = numbered.where("rn = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("root"), h)
    first = numbered.where(F.col("rn") < heads).select(F.col("conv_id").alias("root"), "rn", "d", "n")
    taken = convs.where("h > 0").join(first, "root").where("rn <= h").select("conv_id", "rn", "d", "n")
    own = numbered.where(F.col("rn") > h).select("conv_id", "rn", "d", "n")
    none = convs.select("conv_id", F.lit(0).cast("bigint").alias("rn"), F.lit(None).cast("string").alias("d"),
                        F.lit(None).cast("bigint").alias("n"))
    s = taken.unionByName(own).unionByName(none).groupBy("conv_id") \
        .agg(F.filter(F.sort_array(F.collect_list(F.struct("rn", "d", "n"))), lambda x: x.rn > 0).alias("s"))
    s = s.select("conv_id", F.unhex(F.array_join(F.transform("s", lambda x: x.d), "")).alias("key"),
                 F.transform("s", lambda x: x.n).alias("lens"))
    return s.withColumn("sd", F.md5("key"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sd, conv_id) sorted -> (sd, first, n, ids joined) of at most PIECE ids."""

    def out(rows):
        return pa.RecordBatch.from_pylist([{"sd": k, "first": i[0], "n": len(i), "ids": ",".join(map(str, i))} for k, i in rows],
                                          pa.schema([("sd", pa.string()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())]))

    key, ids = None, []
    for b in batches:
        done = []
        for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if ids and (k != key or len(ids) == PIECE):
                done.append((key, ids))
                ids = []
            key = k
            ids.append(c)
        if done:
            yield out(done)
    if ids:
        yield out([(key, ids)])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (sd, first) -> (least conv_id, n, SHA-256 of all ids joined), as a stream."""

    def out(rows):
        return pa.RecordBatch.from_pylist([{"conv_id": f, "n": n, "ends": h.hexdigest()} for f, n, h in rows],
                                          pa.schema([("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string())]))

    key, at = None, None
    for b in batches:
        done = []
        for k, f, n, ids in zip(*(b.column(i).to_pylist() for i in range(4))):
            if at is not None and k == key:
                at[1] += n
                at[2].update(b"," + ids.encode())
                continue
            if at is not None:
                done.append(at)
            key, at = k, [f, n, hashlib.sha256(ids.encode())]
        if done:
            yield out(done)
    if at is not None:
        yield out([at])


def grouped(seqs: DataFrame) -> DataFrame:
    """Distinct sequences: conv_id (least member), n (members), ends (hash of their ids), key, lens."""
    parts = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = seqs.select("sd", "conv_id").repartitionByRange(parts, "sd", "conv_id").sortWithinPartitions("sd", "conv_id") \
        .mapInArrow(_pieces, "sd string, first bigint, n bigint, ids string")
    groups = pieces.repartition(parts, "sd").sortWithinPartitions("sd", "first") \
        .mapInArrow(_digests, "conv_id bigint, n bigint, ends string")
    return groups.join(seqs.drop("sd"), "conv_id")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """The rows of a sorted partition in runs: (number, rows)."""
    number, rows, size = 0, [], 0
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if len(rows) == RUN or size >= RUN_BYTES:
                yield number, rows
                number, rows, size = number + 1, [], 0
            rows.append(row)
            size += len(row[1])
    if rows:
        yield number, rows


def common_turns(a: bytes, b: bytes) -> int:
    """Turns in the longest common prefix."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    if a[:high * WIDTH] == b[:high * WIDTH]:
        return high
    while high - low > 1:  # equal up to low, different up to high
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid * WIDTH] == b[:mid * WIDTH] else (low, mid)
    return low


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last sequence of each run."""
    for number, rows in _runs(batches):
        yield pa.RecordBatch.from_pydict({"pid": pa.array([rows[0][0]], pa.int64()), "run": pa.array([number], pa.int64()),
                                          "head": pa.array([rows[0][1]], pa.binary()), "tail": pa.array([rows[-1][1]], pa.binary())})


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Common prefix of each run with the runs before and after it; -1 where there is none."""
    for b in batches:
        pid, run, head, tail, before, after = (c.to_pylist() for c in b.columns)
        lo = [-1 if x is None else common_turns(x, h) for x, h in zip(before, head)]
        hi = [-1 if x is None else common_turns(t, x) for x, t in zip(after, tail)]
        yield pa.RecordBatch.from_pydict({"pid": pid, "run": run, "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64())})


ROWS = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string, pid bigint, run bigint, side int, up bigint, prefix binary, len bigint")
NAMES = [c.split()[0] for c in ROWS.split(", ")]
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Node:
    """The deepest node of a component: members, and the sums of its closed children."""

    __slots__ = ("depth", "conv", "n", "children", "leaves", "saved", "ends", "row", "left", "right", "pending")

    def __init__(self, depth, conv, n, ends, row, left, right):
        self.depth, self.conv, self.n, self.ends, self.row, self.left, self.right = depth, conv, n, ends, row, left, right
        self.children = self.leaves = self.saved = 0
        self.pending = []  # rows that wait for this node's least member


def forest(rows: list[tuple], lo: int, hi: int, pid: int = 0, run: int = 0) -> list[list]:
    """Rows of a run's nodes in the order of NAMES. ``rows``: (pid, key, conv_id, n, ends, lens), sorted by key;
    ``lo`` / ``hi``: common prefix with the neighbouring runs. Shared nodes have ``prefix`` and ``side`` (0 left, 1 right)
    and hold only what is closed below them; closed nodes under a shared one have ``side`` and ``up``, its depth."""
    last = len(rows) - 1
    keys = [r[1] for r in rows]
    lcp = [common_turns(keys[i], keys[i + 1]) for i in range(last)]
    tops = [Node(len(r[1]) // WIDTH, r[2], r[3], r[4], i, i, i) for i, r in enumerate(rows)]
    up = list(range(len(rows)))
    paths = []
    for key, depth in ((keys[0], lo), (keys[-1], hi)):
        h, path = hashlib.blake2b(digest_size=WIDTH), []
        for j in range(depth + 1):
            path.append(h.copy().digest())
            h.update(key[j * WIDTH:(j + 1) * WIDTH])
        paths.append(path)
    out: list[list] = []

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def climb(x: Node, stop: int) -> tuple[int, int, int, list]:
        """Gives out the chain from a finished node up to below depth ``stop``: what it adds to its parent."""
        children, leaves, saved, ends, pending = x.children, x.leaves, x.saved, x.ends, x.pending
        lens = rows[x.row][5]
        for j in range(x.depth, stop, -1):
            size = lens[j - 1] if j else 0
            sides = [s for s, edge, depth in ((0, x.left == 0, lo), (1, x.right == last, hi)) if edge and j <= depth]
            if sides:
                for p in pending:
                    p[10], p[11] = sides[0], j
                for s in sides:
                    whole = s == sides[0]
                    out.append([x.conv, j, None, x.n * whole, children * whole, leaves * whole, saved * whole, ends,
                                pid, run, s, None, paths[s][j], size])
                children, leaves, saved, ends, pending = 0, 0, 0, None, []
                continue
            for p in pending:
                p[2] = x.conv
            leaves, saved = leaves or 1, saved + (x.n - 1) * size
            out.append([x.conv, j, None, x.n, children, leaves, saved, ends or NO_ENDS, pid, run, None, None, None, None])
            children, ends, pending = 1, None, [out[-1]]
        return children, leaves, saved, pending

    for i in sorted(range(last), key=lambda i: -lcp[i]):
        depth, a, b = lcp[i], find(i), find(i + 1)
        x, y = tops[a], tops[b]
        into = x if x.depth == depth else y if y.depth == depth else Node(depth, x.conv, 0, None, x.row, x.left, y.right)
        for part in (x, y):
            if part is not into:
                if part.depth == depth:
                    add = part.children, part.leaves, part.saved, part.pending
                    into.ends = into.ends or part.ends
                else:
                    add = climb(part, depth)
                into.children += add[0]
                into.leaves += add[1]
                into.saved += add[2]
                into.pending += add[3]
                into.n += part.n
                into.conv = min(into.conv, part.conv)
        into.left, into.right = x.left, y.right
        up[b], tops[a] = a, into
    climb(tops[find(0)], -1)
    return out


def _forests(edges: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
        types = [kinds[c.split()[1]] for c in ROWS.split(", ")]
        for number, rows in _runs(batches):
            pid = rows[0][0]
            out = forest(rows, *edges[pid, number], pid, number)
            for at in range(0, len(out), RUN):
                cols = zip(*out[at:at + RUN])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=NAMES)

    return run


OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def merge_borders(rows: DataFrame) -> DataFrame:
    """All nodes from the rows of all runs: shared parts are merged, closed rows below them get their parent."""
    parts = rows.where("prefix IS NOT NULL")
    path, own = ["pid", "run", "side"], F.struct("pid", "run", "side")
    merged = written(parts.groupBy("depth", "prefix").agg(
        F.min("conv_id").alias("m_conv"), F.sum("n_convs").alias("m_n"), F.sum("n_children").alias("m_children"),
        F.sum("n_leaves").alias("m_leaves"), F.sum("saved_tokens").alias("m_saved"), F.max("ends_sha256").alias("m_ends"),
        F.max("len").alias("m_len"), F.min(own).alias("m_path")))
    # every shared node counts on one of its border paths; sums run along the paths, deepest first
    on = parts.select(*path, "depth", "prefix").join(merged, ["depth", "prefix"])
    here = F.when(F.col("m_path") == own, 1).otherwise(0)
    on = on.withColumn("here", here)
    down = Window.partitionBy(*path).orderBy(F.col("depth").desc())
    sums = down.rowsBetween(Window.unboundedPreceding, 0)
    on = on.withColumn("s_saved", F.sum(F.col("here") * (F.col("m_saved") + (F.col("m_n") - 1) * F.col("m_len"))).over(sums)) \
        .withColumn("s_leaves", F.sum(F.col("here") * F.col("m_leaves")).over(sums)) \
        .withColumn("s_children", F.coalesce(F.lag("here").over(down), F.lit(0))) \
        .withColumn("parent", F.lead("m_conv").over(down))
    on = written(on)
    shared = on.groupBy("depth", "prefix").agg(
        F.first("m_conv").alias("conv_id"), F.max("parent").alias("parent_conv_id"), F.first("m_n").alias("n_convs"),
        (F.first("m_children") + F.sum("s_children")).alias("n_children"), F.sum("s_leaves").alias("n_leaves"),
        F.sum("s_saved").alias("saved_tokens"), F.coalesce(F.first("m_ends"), F.lit(NO_ENDS)).alias("ends_sha256"))
    closed = rows.where("prefix IS NULL")
    above = on.select(*path, F.col("depth").alias("up"), "m_conv")
    waiting = closed.where("up IS NOT NULL").drop("parent_conv_id").join(above, [*path, "up"]) \
        .withColumnRenamed("m_conv", "parent_conv_id")
    return closed.where("up IS NULL").select(*OUT).unionByName(waiting.select(*OUT)).unionByName(shared.select(*OUT))


def trie(seqs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``seqs`` (conv_id, key, lens, sd)."""
    spark = seqs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seqs = written(seqs)
    ordered = grouped(seqs).select("key", "conv_id", "n", "ends", "lens").repartitionByRange(n, "key").sortWithinPartitions("key") \
        .select(F.spark_partition_id().cast("bigint").alias("pid"), "key", "conv_id", "n", "ends", "lens")
    ordered = cut_lineage(ordered)
    line = Window.orderBy("pid", "run")
    ends = ordered.select("pid", "key").mapInArrow(_ends, "pid bigint, run bigint, head binary, tail binary") \
        .withColumn("before", F.lag("tail").over(line)).withColumn("after", F.lead("head").over(line))
    edges = {(r[0], r[1]): (r[2], r[3]) for r in  # two numbers for each run
             ends.mapInArrow(_borders, "pid bigint, run bigint, lo bigint, hi bigint").collect()}
    return merge_borders(written(ordered.mapInArrow(_forests(edges), ROWS)))


def prefix_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations, the empty one included."""
    return trie(rebuilt(turns(conversations, **columns)))
