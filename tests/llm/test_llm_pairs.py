"""SimHash, components, mixing, top-k and repeats against brute force and on odd input."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tabtext.llm import components, mixing, simhash, suffix, topk

SF1 = "/root/testdata/sf0.01"


def brute_fingerprint(text, k=3):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())) if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, radius):
    keys = sorted(set(fps))
    up = {f: f for f in keys}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                up[root(a)] = root(b)
    return {f: root(f) for f in keys}


@pytest.mark.parametrize("which", ["odd", "documents", "near"])
def test_simhash(spark, which):
    if which == "documents":
        docs = spark.read.parquet(f"{SF1}/documents.parquet")
    else:
        texts = [None, "", "  ", "a", "A", "a b", "a b c", "x " * 9000, "same thing here now", "same thing here now"]
        if which == "near":
            rng = random.Random(5)
            base = [f"w{i}" for i in range(300)]
            texts = []
            for i in range(400):
                t = list(base)
                t[rng.randrange(300)] = f"v{i}"
                texts.append(" ".join(t))
        docs = spark.createDataFrame([(None if i == 3 else 7 * i % 1009, t) for i, t in enumerate(texts)], "doc_id bigint, text string") \
            .withColumn("_sim_fp", F.lit(1))
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    comp = brute_components([f for _, f in rows], 2)
    least = {}
    for d, f in rows:
        if d is not None:
            least[comp[f]] = min(d, least.get(comp[f], d))
    got = simhash.near_duplicates(docs).collect()
    assert Counter(map(tuple, got)) == Counter((d, f"{f:016x}", least.get(comp[f])) for d, f in rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = Counter(least.get(c) for c in set(comp.values()))
    assert Counter(r.doc_id for r in kept.collect()) == want


def test_simhash_random_fingerprints(spark):
    """Links across partition borders of the index: clusters within a few bits around random centres."""
    rng = random.Random(1)
    fps = set()
    for _ in range(40):
        c = rng.getrandbits(64)
        for _ in range(60):
            x = c
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    comp = brute_components(fps, 2)
    g = {r.node % (1 << 64): r.root for r in simhash.fingerprint_groups(spark.createDataFrame(signed, "fp bigint")).collect()}
    groups, want = {}, {}
    for f in fps:
        groups.setdefault(g.get(f, f"alone {f}"), set()).add(f)
        want.setdefault(comp[f], set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_simhash_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    assert simhash.keep_one(spark.createDataFrame([], "doc_id bigint, text string, x int")).count() == 0


def test_gray_rank_orders_one_bit_apart():
    f = np.arange(256, dtype=np.uint64)
    f = f[np.argsort(simhash._gray_rank(f))]
    assert (np.bitwise_count(f[1:] ^ f[:-1]) == 1).all()


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (5, 5), (None, 1), (2, 1)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7} | {100 + i: 100 for i in range(41)}


def test_pfair_deviation():
    for w in ({"a": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 700, "b": 299, None: 1}, {str(i): i + 1 for i in range(12)}):
        slots, total, seen = mixing.period(w), sum(w.values()), Counter()
        for t, s in enumerate(slots, 1):
            seen[s] += 1
            assert all(abs(seen[k] * total - w[k] * t) < total for k in w)
        assert seen == Counter(w)


def test_mixing_places_every_row_once(spark):
    rows = [(i if i % 50 else None, None if i % 7 == 0 else f"s{i % 7 // 3}", f"t{i}") for i in range(500)] + [(3, "s1", "t3")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumn("position", F.lit("x")) \
        .withColumn("SLOT", F.lit(1))
    s = mixing.schedule(docs, block=4).collect()
    assert len(s) == len(rows) and len({r.position for r in s}) == len(rows)
    weights = mixing.default_weights(docs)
    total, seen = sum(weights.values()), Counter()
    slots = sorted({(r.slot, r.source) for r in s}, key=lambda x: x[0])
    dry = min(max(t for t, k in slots if k == src) for src in weights)
    for t, k in slots:
        if t <= dry:
            seen[k] += 1
            assert all(abs(seen[x] * total - weights[x] * (t + 1)) < total for x in weights)
    mixed = mixing.mix(docs, block=4)
    assert mixed.columns == docs.columns and Counter(map(tuple, mixed.collect())) == Counter(map(tuple, docs.collect()))
    assert mixing.schedule(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.schedule(docs, {"s0": 1})


def test_topk_against_scan(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8).round(2)]) for i in range(300)]
    rows += [(i, rows[5][1]) for i in range(300, 360)]  # ties
    rows += [(400, None), (401, []), (402, [None] * 8), (403, [float("nan")] * 8), (404, [float("inf")] * 8), (None, rows[0][1]),
             (420, [1.0, 2.0]), (421, [3.0, 1.0]), (20, rows[7][1]), (440, [2.0 ** 40, -(2.0 ** 41)])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit(1))
    good = [(i, tuple(int(np.floor(64 * x)) for x in v)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = Counter()
    for qi, q in set(x for x in good if x[0] % 20 == 0):
        s = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in good if i != qi and len(v) == len(q))[:20]
        want.update((qi, n, i, -neg) for n, (neg, i) in enumerate(s, 1))
    for block, group, band in ((256, 32, 16), (7, 3, 1)):
        got = topk.search(df, block=block, group=group, band=band).collect()
        assert Counter(map(tuple, got)) == want
    assert topk.search(df.limit(0)).count() == 0


def test_topk_prunes_blocks():
    rng = np.random.default_rng(0)
    blocks = [(np.arange(64) + 64 * b, (rng.integers(0, 5, (64, 16)) + (1000 if b == 3 else 0))) for b in range(20)]
    found, scored = topk.Group(blocks).search(np.array([-1]), np.ones((1, 16), np.int64), 20)
    assert scored == 1 and all(64 * 3 <= i < 64 * 4 for i in found[0][1])


def brute_repeats(texts, length, first=False):
    places = {}
    for d, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            places.setdefault(t[p:p + length], []).append((d, p))
    gone = [np.zeros(len(t), bool) for t in texts]
    for at in places.values():
        for d, p in (at[1:] if first else at) if len(at) > 1 else []:
            gone[d][p:p + length] = True
    return gone


@pytest.mark.parametrize("length,pieces,keep", [(9, 8192, "none"), (9, 1, "none"), (24, 8192, "none"), (9, 8192, "first"),
                                                (9, 1, "first"), (200, 8192, "none")])
def test_repeats(spark, length, pieces, keep):
    rng = random.Random(length + pieces)
    passage = "".join(rng.choice("abcd") for _ in range(3 * length))
    texts = ["", "ab" * length, "a" * (5 * length), "é" * length, passage, "x" + passage + "y", passage[: length - 1]]
    for i in range(60):
        t = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(4 * length)))
        if i % 3 == 0:
            a = rng.randrange(2 * length)
            t += passage[a:a + rng.randrange(2 * length)] + "".join(rng.choice("abcdefgh ") for _ in range(9))
        texts.append(t)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9999, None)], "doc_id bigint, text string") \
        .withColumn("KEY", F.lit(1)).withColumn("h", F.lit(1))
    gone = brute_repeats([t.encode() for t in texts], length, keep == "first")
    got = {r.doc_id: r for r in suffix.remove_repeats(docs, length=length, keep=keep, max_pieces=pieces).collect()}
    assert len(got) == len(texts) + 1 and got[9999].n_bytes == 0
    for i, t in enumerate(texts):
        b = np.frombuffer(t.encode(), np.uint8)
        kept = b[~gone[i]].tobytes()
        assert got[i].n_removed == gone[i].sum() and bytes(got[i].kept) == kept, i
        assert got[i].n_spans == (np.diff(np.append(0, gone[i].astype(int))) == 1).sum()
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_repeats_equal_rows_and_null_ids(spark):
    t = "".join(random.Random(4).choice("abcdefgh") for _ in range(300))
    docs = spark.createDataFrame([(1, t), (1, t), (None, t[:250]), (None, "short"), (0, t[50:] + "z")], "doc_id bigint, text string")
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_removed) for r in suffix.remove_repeats(docs).collect())
    assert [x[2:] for x in got] == [(251, 250), (300, 300), (300, 300), (5, 0), (250, 250)] or Counter(x[2:] for x in got) == Counter(
        [(251, 250), (300, 300), (300, 300), (5, 0), (250, 250)])
    assert suffix.remove_repeats(docs.limit(0)).count() == 0


def test_prefix_ranks():
    rng = np.random.default_rng(0)
    for high in (3, 256):
        text = rng.integers(0, high, 500).astype(np.uint8)
        for n in (1, 3, 8, 13, 40):
            r, raw = suffix.prefix_ranks(text, n), text.tobytes() + bytes(n)
            keys = [raw[i:i + n] for i in range(500)]
            order = sorted(range(500), key=lambda i: keys[i])
            for a, b in zip(order, order[1:]):
                assert (r[a] == r[b]) == (keys[a] == keys[b]) and r[a] <= r[b]
