"""Repeated-substring removal by longest-previous-factor arrays.

A byte goes when a string of ``length`` bytes that covers it starts at another place too (``keep="none"``),
or at an earlier place in the order of doc_id (null as 0), text hash and offset (``keep="first"``: later
copies go, the first stays). Texts are UTF-8 bytes; strings never cross documents.

1. Every string of ``length`` bytes holds ``length - k + 1`` substrings of k bytes; the smallest of their
   hashes is its anchor. The anchor depends on the string alone, so equal strings meet under one anchor.
   Consecutive starts with one anchor form a piece (at most ``length - k + 1`` starts).
2. Anchors of one piece in the corpus are dropped (unless the piece may repeat inside itself). Pieces that agree as a whole (two 64-bit hashes) are
   settled by counting them.
3. Differing pieces of one anchor are compared exactly: their bytes are laid end to end, prefix doubling
   gives the order of the suffixes, and the previous and next smaller positions in that order give the
   longest previous factor of each start; one of ``length`` bytes or more marks a later copy.
4. An anchor with more than ``MAX_PIECES`` distinct pieces would be too much for one task: its starts are
   dealt by two 64-bit hashes of their whole string instead, which is the exact way for the rest.

Null and empty texts have nothing to remove. Repeated rows are copies of each other like any others; rows
that agree in id and text share their result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabtext.llm.common import SEGMENT, mix64, ship_by_value, small_batches, text_buffers
from tabtext.session import cut_lineage

ship_by_value(__name__)

LENGTH = 200
MAX_PIECES = 8192
BATCH = 1 << 20  # bytes of pieces compared at once
B1, B2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def gram_size(length: int) -> int:
    return 1 << max(0, (length // 3).bit_length() - 1)


def _pow(base: int, e: int) -> np.uint64:
    return np.uint64(pow(base, e, 1 << 64))


def window_hashes(b: np.ndarray, sizes: list[int], base: int = B1) -> list[np.ndarray]:
    """Hash of every window of each size, by doubling: hash(2n at i) = hash(n at i) + base**n * hash(n at i+n)."""
    top, levels, n = max(sizes), [b.astype(np.uint64) + np.uint64(1)], 1
    while 2 * n <= min(top, len(b)):
        h = levels[-1]
        levels.append(h[:len(h) - n] + _pow(base, n) * h[n:])
        n *= 2
    out = []
    for size in sizes:
        count, at, acc = len(b) - size + 1, 0, None
        if count <= 0:
            out.append(np.zeros(0, np.uint64))
            continue
        for bit in range(size.bit_length() - 1, -1, -1):
            if size >> bit & 1:
                part = levels[bit][at:at + count]
                acc = part.copy() if acc is None else acc + _pow(base, at) * part
                at += 1 << bit
        out.append(mix64(acc))
    return out


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    m, n = h, 1
    while 2 * n <= width:
        m = np.minimum(m[:len(m) - n], m[n:])
        n *= 2
    count = len(h) - width + 1
    return np.minimum(m[:count], m[width - n:width - n + count])


def pieces(data: np.ndarray, offsets: np.ndarray, length: int):
    """Pieces of documents laid end to end: document, first start, number of starts, anchor, hash of the
    piece's bytes, and whether the anchor stands at several places, so that starts inside the piece may
    repeat each other (periodic text)."""
    k = gram_size(length)
    width = length - k + 1
    out = [[] for _ in range(6)]
    for a in range(0, max(0, len(data) - length + 1), SEGMENT):
        z = min(a + SEGMENT, len(data) - length + 1)  # starts a .. z-1
        h, whole = window_hashes(data[a:z + length - 1], [k, length])
        anchor = sliding_min(h, width)
        start = np.arange(a, z)
        doc = np.searchsorted(offsets, start, "right") - 1
        fits = start + length <= offsets[doc + 1]
        new = np.empty(z - a, bool)
        new[0] = True
        new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        new &= fits
        lo = np.flatnonzero(new)
        if not len(lo):
            continue
        # a run ends where the next one starts or where strings no longer fit
        ends = np.append(lo[1:], z - a)
        gone = np.flatnonzero(~fits)
        nxt = np.searchsorted(gone, lo)
        stop = np.where(nxt < len(gone), gone[np.minimum(nxt, len(gone) - 1)] if len(gone) else z - a, z - a)
        n = np.minimum(ends, stop) - lo
        parts = -(-n // width)  # long runs (periodic text) are cut
        lo = np.repeat(lo, parts) + width * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        n = np.minimum(width, np.repeat(np.minimum(ends, stop), parts) - lo)
        last = lo + n - 1
        body = mix64(whole[lo] * np.uint64(B2) + mix64(whole[last] + n.astype(np.uint64)))
        # places that are the anchor of some string: the largest minimum over the windows that hold them
        edge = np.zeros(width - 1, np.uint64)
        peaks = np.flatnonzero(h == ~sliding_min(~np.concatenate([edge, anchor, edge]), width))
        x, y = np.searchsorted(peaks, lo), np.searchsorted(peaks, last + width - 1, "right")
        owner = np.repeat(np.arange(len(lo)), y - x)
        at = peaks[np.arange(len(owner)) - np.repeat(np.cumsum(y - x) - (y - x), y - x) + np.repeat(x, y - x)]
        inner = np.bincount(owner[h[at] == anchor[lo][owner]], minlength=len(lo)) > 1
        for o, v in zip(out, (doc[lo], lo + a, n, anchor[lo], body, inner)):
            o.append(v)
    if not out[0]:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))
    return tuple(np.concatenate(o) for o in out)


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffers(b.column(2))
            doc, lo, n, h, c, inner = pieces(data, off, length)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc)), b.column(1).take(pa.array(doc)),
                 pa.array((lo - off[doc]).astype(np.int32)), pa.array(n.astype(np.int32)),
                 pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(inner)],
                names=["id", "key", "lo", "n", "h", "c", "inner"])

    return run


def _cut_rows(length: int):
    """Bytes of the wanted pieces of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffers(b.column(2))
            buf = data.tobytes()
            out = [[] for _ in range(7)]
            for r in range(b.num_rows):
                for w in b.column(3)[r].as_py():
                    a = int(off[r]) + w["lo"]
                    for o, v in zip(out, (w["h"], b.column(0)[r].as_py(), b.column(1)[r].as_py(), w["lo"], w["n"],
                                          w["many"], buf[a:a + w["n"] + length - 1])):
                        o.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, kinds)],
                                             names=["h", "id", "key", "lo", "n", "many", "body"])

    return run


def prefix_ranks(text: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length``-byte prefix of every suffix (equal prefixes share a rank), by doubling."""
    rank, n = np.concatenate([text, np.zeros(length, np.uint8)]).astype(np.uint64), 1
    while n < length:
        step = n if 2 * n <= length else length - n
        rank = rank[:len(rank) - step] * (rank.max(initial=np.uint64(0)) + np.uint64(1)) + rank[step:]
        n += step
        if n > 4:  # up to 4 bytes the pair is a small number already; longer ones are ranked anew
            rank = np.unique(rank, return_inverse=True)[1].astype(np.uint64)
    return rank[:len(text)]


def previous_and_next(rank: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix: has it an earlier, has it a later suffix whose common prefix reaches ``length``?
    In suffix order, with equal prefixes ordered by place, the previous smaller place of a suffix inside its
    run of equal prefixes is its left neighbour and gives the longest previous factor; the next larger place
    is its right neighbour."""
    order = np.lexsort((place, rank))
    same = rank[order][1:] == rank[order][:-1]
    earlier, later = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    earlier[order[1:]] = same
    later[order[:-1]] = same
    return earlier, later


def repeated_starts(bodies: list[bytes], counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, start inside it, has an earlier copy) of all starts whose string occurs more than once among
    the pieces, which are given in corpus order."""
    sizes = np.array([len(x) for x in bodies], np.int64)
    base = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(bodies), np.uint8)
    piece = np.repeat(np.arange(len(bodies)), counts)
    inside = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = base[piece] + inside
    # strings whose hash is unique here have no copy; suffixes are ordered for the pieces of the others
    _, inv, num = np.unique(window_hashes(text, [length])[0][at], return_inverse=True, return_counts=True)
    some = np.unique(piece[num[inv] > 1])
    if not len(some):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, bool)
    keep = np.isin(piece, some)
    new_base = np.zeros(len(bodies), np.int64)
    new_base[some] = np.cumsum(sizes[some]) - sizes[some]
    sub = np.frombuffer(b"".join(bodies[i] for i in some), np.uint8)
    piece, inside = piece[keep], inside[keep]
    at = new_base[piece] + inside
    earlier, later = previous_and_next(prefix_ranks(sub, length)[at], np.arange(len(at)))
    hit = earlier | later
    return piece[hit], inside[hit], earlier[hit]


def _runs(doc: list, start: np.ndarray, length: int):
    """Joined byte ranges [start, start + length) per document reference; input sorted by piece and start."""
    out: list[list] = []
    for d, s in zip(doc, start.tolist()):
        if out and out[-1][0] == d and out[-1][1] <= s <= out[-1][2]:
            out[-1][2] = s + length
        else:
            out.append([d, s, s + length])
    return out


SPAN = "id bigint, key bigint, a int, z int"


def _spans(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0][0] for r in rows], pa.int64()), pa.array([r[0][1] for r in rows], pa.int64()),
         pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32())],
        names=["id", "key", "a", "z"])


def _compare(length: int, first: bool):
    """Rows sorted by anchor and corpus order -> byte ranges to remove."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def flush():
            ref = [x[0] for x in held]
            lo = np.array([x[1] for x in held], np.int64)
            piece, inside, earlier = repeated_starts([x[3] for x in held], np.array([x[2] for x in held], np.int64), length)
            if first:
                piece, inside = piece[earlier], inside[earlier]
            return _spans(_runs([ref[p] for p in piece.tolist()], lo[piece] + inside if len(piece) else piece, length))

        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(7)]
            for h, i, key, lo, n, _, body in zip(*cols):
                if h == last and held and held[-1][:2] == ((i, key), lo):
                    continue  # rows that agree in id and text bring the same piece twice
                if h != last and size >= BATCH:
                    yield flush()
                    held, size = [], 0
                last = h
                held.append(((i, key), lo, n, body))
                size += len(body)
        if held:
            yield flush()

    return run


def _deal(length: int):
    """Every start of a piece with two hashes of its string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                t = np.frombuffer(b.column(6)[r].as_py(), np.uint8)
                n, lo = b.column(4)[r].as_py(), b.column(3)[r].as_py()
                w1, w2 = window_hashes(t, [length])[0], window_hashes(t, [length], B2)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)),
                     pa.array(np.full(n, b.column(1)[r].as_py(), np.int64)), pa.array(np.full(n, b.column(2)[r].as_py(), np.int64)),
                     pa.array((lo + np.arange(n)).astype(np.int32))], names=["w1", "w2", "id", "key", "a"])

    return run


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id (0 for null), key (hash of text and of whether the id is null), text."""
    return docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(0)).alias("id"),
                       F.xxhash64(F.col(text), F.col(doc_id).isNull()).alias("key"), F.col(text).alias("text"))


def repeated_ranges(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                    keep: str = "none", max_pieces: int = MAX_PIECES) -> DataFrame:
    """(id, key, a, z): byte ranges to remove, possibly overlapping; see ``_keyed`` for id and key."""
    if keep not in ("none", "first"):
        raise ValueError(keep)
    small_batches(docs.sparkSession)
    d = _keyed(docs, doc_id, text)
    long = d.where(F.octet_length("text") >= length)
    anchors = long.mapInArrow(_anchor_rows(length), "id bigint, key bigint, lo int, n int, h bigint, c bigint, inner boolean")
    often = anchors.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.max("inner").alias("i")) \
        .where((F.col("k") > 1) | F.col("i")).select("h")
    # an aggregate written out joins through an exchange of its own, so that adaptive execution can split a hot anchor
    found = cut_lineage(anchors.join(cut_lineage(often).hint("shuffle_merge"), "h"))
    # document order: key tells null ids apart, which come last
    ref = F.struct("id", "key", "lo", "n")
    classes = cut_lineage(found.groupBy("h", "c").agg(F.count(F.lit(1)).alias("copies"), F.min(ref).alias("ref"),
                                                       F.max("inner").alias("inner")))
    kinds = classes.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.max("inner").alias("i")) \
        .where((F.col("kinds") > 1) | F.col("i"))
    unsettled = cut_lineage(classes.join(cut_lineage(kinds), "h")
                            .select("h", "ref.*", (F.col("kinds") > max_pieces).alias("many")))
    same = classes.where(F.col("copies") > 1).select("h", "c", "ref")
    settled = found.join(same, ["h", "c"])
    if keep == "first":
        settled = settled.where(F.struct("id", "key", "lo", "n") != F.col("ref"))
    spans = settled.select("id", "key", F.col("lo").alias("a"), (F.col("lo") + F.col("n") + (length - 1)).alias("z"))
    wanted = unsettled.groupBy("id", "key").agg(F.collect_list(F.struct("h", "lo", "n", "many")).alias("w"))
    bodies = d.join(wanted, ["id", "key"]).select("id", "key", "text", "w") \
        .mapInArrow(_cut_rows(length), "h bigint, id bigint, key bigint, lo int, n int, many boolean, body binary")
    spans = spans.union(bodies.where(~F.col("many")).repartition("h").sortWithinPartitions("h", "id", "key", "lo")
                        .mapInArrow(_compare(length, keep == "first"), SPAN))
    if unsettled.where("many").limit(1).count():
        dealt = bodies.where("many").mapInArrow(_deal(length), "w1 bigint, w2 bigint, id bigint, key bigint, a int")
        place = F.struct("id", "key", "a")
        seen = dealt.groupBy("w1", "w2").agg(F.min(place).alias("ref"), F.max(place).alias("end")) \
            .where(F.col("ref") != F.col("end"))
        again = dealt.join(seen, ["w1", "w2"])
        if keep == "first":
            again = again.where(F.struct("id", "key", "a") != F.col("ref"))
        spans = spans.union(again.select("id", "key", "a", (F.col("a") + length).alias("z")))
    return spans


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, off = text_buffers(b.column(1))
        n_removed, n_spans, kept = [], [], []
        for r in range(b.num_rows):
            t = data[off[r]:off[r + 1]]
            w = b.column(2)[r].as_py()
            if not w:
                n_removed.append(0)
                n_spans.append(0)
                kept.append(t.tobytes())
                continue
            edge = np.zeros(len(t) + 1, np.int32)
            np.add.at(edge, [x["a"] for x in w], 1)
            np.add.at(edge, [x["z"] for x in w], -1)
            gone = np.cumsum(edge[:-1]) > 0
            n_removed.append(int(gone.sum()))
            n_spans.append(int((gone & ~np.append(False, gone[:-1])).sum()))
            kept.append(t[~gone].tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(np.diff(off), pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary()),
             pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   keep: str = "none", max_pieces: int = MAX_PIECES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (remaining bytes), kept_sha256 for every row."""
    spans = repeated_ranges(docs, doc_id, text, length, keep, max_pieces) \
        .groupBy("id", "key").agg(F.collect_set(F.struct("a", "z")).alias("w"))
    d = _keyed(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id", "text")
    back = F.when(F.col("key") == F.xxhash64("text", F.lit(False)), F.col("id"))
    return d.join(spans, ["id", "key"], "left").select(back.alias("doc_id"), "text", "w") \
        .mapInArrow(_strip, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string")
