"""Prefix trie, recurrent language model and ranked search against brute force and on odd input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabtext.llm import gatedlm, lexical, prefixtrie

SF0 = "/root/testdata/sf0.001"


# ---- prefix trie -------------------------------------------------------------------------------------------------

def brute_trie(rows):
    """rows: (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            d = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append(((t is not None, t or 0, d), role, text))
    seq = {c: [(r, x) for _, r, x in sorted(v, key=lambda z: z[0])] for c, v in convs.items()}
    built = {}
    for c in seq:
        h = zlib.crc32(str(c).encode()) % 6
        root = c - int(math.fmod(c, 100))
        built[c] = tuple(seq.get(root, [])[:h] + seq[c][h:])
    nodes = {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(x[:len(q)] == q and len(x) > len(q) for x in below)]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(c for c in members if built[c] == p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def make(seed, n, deep=6):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rng.choice([rng.randrange(-250, 400), rng.randrange(0, 60)])
        for t in range(rng.randrange(1, deep)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ccc é", "a"])))
    return rows


@pytest.mark.parametrize("run", [1, 3, 20_000])
def test_trie_against_brute_force(spark, monkeypatch, run):
    """Also with runs so short that most nodes are shared between runs."""
    monkeypatch.setattr(prefixtrie, "RUN", run)
    rows = make(run, 150)
    rows += [(1000 + i, t, "user", f"common {t}") for i in range(80) for t in range(4)]  # a group of copies
    rows += [(3000 + i, t, "user", f"long {t}") for i in range(3) for t in range(40 + i)]
    rows += [(5, None, None, None), (5, None, "user", None), (5, 0, "user", ""), (None, 1, "user", "lost"), (77, 9, "x", "y")]
    rows += rows[:7]  # repeated rows
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).withColumn("pid", F.lit("x"))
    got = sorted((tuple(r) for r in prefixtrie.prefix_trie(df).collect()), key=str)
    assert got == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert prefixtrie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefixtrie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0


def test_trie_long_texts_and_one_conversation(spark):
    rows = [(200, t, "user", "é" * 300_000) for t in range(3)]
    got = sorted((tuple(r) for r in prefixtrie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == brute_trie(rows)


def test_pieces_of_a_large_group_hash_as_one(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "PIECE", 7)
    rows = [(c, 0, "user", "same") for c in range(100, 400)]
    got = sorted((tuple(r) for r in prefixtrie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == brute_trie(rows)


# ---- language model ------------------------------------------------------------------------------------------------

def words_of(counts, model):
    h = np.array([gatedlm.END, *range(1, len(counts))], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return gatedlm.Words(h, np.array(counts), sum(counts), len(counts), model)


def test_probabilities_sum_to_one():
    w = words_of([50, 40, 30, 9, 7, 5, 2, 1, 1], 7)
    m = gatedlm.GatedLM.fresh(w, embed=3, hidden=4, size=3)
    h = np.random.default_rng(1).normal(size=(5, 4)).astype(np.float32)
    p = sum(np.exp(m.outputs(h, np.full(5, y))) for y in range(m.n + 1))
    assert np.allclose(p, 1, atol=1e-5)
    inside = [(c + 1) / w.rare_mass for c in (1, 1, 0)]  # two rare words and all unseen ones
    assert math.isclose(sum(inside), 1)


def test_gradients_are_those_of_the_loss():
    w = words_of([50, 40, 30, 9, 7, 5, 2], 6)
    m = gatedlm.GatedLM.fresh(w, embed=3, hidden=4, size=2)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 7, (5, 2)), rng.integers(0, 7, (5, 2))
    go = np.array([[0, 1], [1, 1], [1, 0], [1, 1], [1, 1]], float)
    h = rng.normal(size=(2, 4))
    _, grad, _ = m.gradients(x, y, go, h)
    for k, v in m.p.items():
        for at in {tuple(rng.integers(0, s) for s in v.shape) for _ in range(6)}:
            keep, loss = v[at], []
            for d in (1e-5, -1e-5):
                v[at] = keep + d
                loss.append(m.gradients(x, y, go, h)[0])
            v[at] = keep
            assert abs((loss[0] - loss[1]) / 2e-5 - grad[k][at]) < 2e-4, (k, at)  # states are kept in single precision


@pytest.mark.filterwarnings("error")
def test_rows_of_a_window_are_apart_in_the_cache():
    for kind, line in ((np.float32, 16), (np.float64, 8)):
        for size in (1, 640, 1024, 5120):
            x = gatedlm.GatedLM._room(3, size, kind)
            assert x.shape == (3, size) and x.dtype == kind
            assert x.strides[0] % 64 == 0 and x.strides[0] // 64 % 2 == 1 and x.strides[0] < 4 * (size + 2 * line) * (16 // line)
            assert np.shares_memory(x, x.reshape(3, size // 1, 1))  # steps and lanes are a view
    x = np.array([-1e4, -90, 0, 90, 1e4], np.float32)
    gatedlm.GatedLM._sigmoid(x)
    assert np.allclose(x, [0, 0, 0.5, 1, 1])


def test_state_is_carried_through_whole_documents():
    w = words_of([50, 40, 30, 9, 7, 5, 2], 6)
    m = gatedlm.GatedLM.fresh(w, embed=3, hidden=4, size=2)
    rng = np.random.default_rng(3)
    lens = [0, 1, 2000, 5, 5, 300]
    y = rng.integers(0, 7, sum(lens))
    off = np.concatenate(([0], np.cumsum(lens)))
    table = m.p["embed"] @ m.p["w_in"] + m.p["b_in"]
    want = []
    for a, z in zip(off, off[1:]):
        h, before, total = np.zeros((1, 4), np.float32), m.n + 1, 0.0
        for t in y[a:z]:
            h = m.step(table[[before]], h)
            total += float(m.outputs(h, np.array([t]))[0])
            before = t
        want.append(total)
    assert np.allclose(m.score(y, off), want, rtol=1e-5)


def test_training_lowers_the_loss_of_a_pattern():
    w = words_of([100] * 6, 6)
    m = gatedlm.GatedLM.fresh(w, embed=4, hidden=8, size=3)
    texts = [np.tile([1, 2, 3, 4, 5], 60)] * 10
    losses = [x for _ in range(3) for x in m.train(texts, 0.02, lanes=4)]
    assert np.mean(losses[-20:]) < 0.3 < 1.2 < losses[0]


def brute_base(rows):
    def tokens(t):
        return [x for x in re.split(rb"[\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (t or "").encode())) if x] + [None]

    aside = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    c = Counter(x for (_, t), a in zip(rows, aside) if not a for x in tokens(t))
    n, v = sum(c.values()), len(c)
    return [(d, a, len(tokens(t)), sum(c[x] > 0 for x in tokens(t)), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in tokens(t)))
            for (d, t), a in zip(rows, aside)]


def close(got, want):
    got, want = sorted(got, key=str), sorted(want, key=str)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(got, want))


def test_lm_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(gatedlm, "HEAD", 20)
    monkeypatch.setattr(gatedlm, "COUNTED", 8)
    rng = random.Random(4)
    rows = [(i, " ".join(f"W{rng.randrange(60) ** 2 // 60}" for _ in range(rng.randrange(30)))) for i in range(120)]
    rows += [(None, "W0 w0é"), (500, None), (501, ""), (502, " \t\n "), (503, "rare " * 5000), rows[0], rows[0], (504, "x" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("rid", F.lit("a")).withColumn("held_out", F.lit(1))
    out = gatedlm.score_documents(docs)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = [tuple(r) for r in out.collect()]
    close([r[:6] for r in got], brute_base(rows))
    assert all(r[6] < 0 and math.isfinite(r[6]) for r in got)


def test_lm_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert gatedlm.score_documents(empty).count() == 0
    aside = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = gatedlm.score_documents(spark.createDataFrame([(aside, "a b")], "doc_id bigint, text string")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_lm_beats_the_counts_on_documents_kept_apart(spark):
    rng = random.Random(7)  # two languages of the same word frequencies: only context tells which words follow
    rows = []
    for i in range(500):
        k = rng.choice("ab")
        rows.append((i, " ".join(f"{k}{min(rng.randrange(40), rng.randrange(40))}" for _ in range(60))))
    got = gatedlm.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).where("held_out")
    r = got.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n"),
                F.avg((F.col("score") > F.col("base_score")).cast("int")).alias("share")).first()
    assert (r.s - r.b) / r.n > 0.2 and r.share > 0.95  # log10(2) = 0.30 is all there is to gain


# ---- ranked search -------------------------------------------------------------------------------------------------

def brute_search(docs, items, k=10):
    def terms(t):
        return [x.lower() for x in re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").encode())]

    tf = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(1 for _, c in tf if c), sum(sum(c.values()) for _, c in tf)
    df = Counter(x for _, c in tf for x in c)
    out = []
    for i, t in set(items):
        found = []
        for d, c in tf:
            s = 0
            for x in set(terms(t)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                s += w * ((10 ** 9 * c[x]) // (1000 * c[x] + 8 * (10 + (90 * sum(c.values()) * n_docs) // total)))
            if s > 0:
                found.append((-s, d is None, d))
        found.sort(key=lambda z: (z[0], z[1], z[2] or 0))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("max_pairs", [200_000, 40])
def test_search_against_brute_force(spark, monkeypatch, max_pairs):
    monkeypatch.setattr(lexical, "WAVE", 2)
    rng = random.Random(8)
    word = lambda: f"T{int(rng.paretovariate(0.6)) % 400}"
    docs = [(rng.randrange(10 ** 6), " ".join(word() for _ in range(rng.randrange(60)))) for _ in range(700)]
    docs += [(None, "t1 T2 t3"), (None, "t1 t2 t3"), (4, None), (5, ""), (6, "t1-t2_t3é"), docs[0], docs[0], (7, "t1 " * 20_000), (8, "Été " * 4)]
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 25)))) for i in range(30)]
    items += [(50, None), (51, "!!"), (52, "absent words"), items[0], (items[0][0], "t1 t2"), (None, "t3 T3 t4"), (53, "été Été")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5).withColumn("score", F.lit("x")).withColumn("q", F.lit(2))
    q = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit("z"))
    got = sorted((tuple(r) for r in lexical.search(d, q, max_pairs=max_pairs).collect()), key=str)
    assert got == brute_search(docs, items)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical.search(docs, items).count() == 0
    assert lexical.search(spark.createDataFrame([(1, "a")], docs.schema), items.limit(0)).count() == 0


def test_pair_bounds_skip_and_lose_nothing():
    """Any threshold gives exactly the documents at or above it; joint maxima cut candidates."""
    rng = np.random.default_rng(9)
    n_terms, size = 30, 400
    key = np.unique(rng.integers(0, n_terms * size, 2500))
    terms, docs = key // size, key % size
    tfs, lengths = rng.integers(1, 6, len(key)), np.full(size, 40)
    weight = rng.integers(100, 4000, n_terms)
    q = lexical.Queries([0], [""], np.arange(n_terms, dtype=np.uint64), [np.arange(n_terms)])
    pairs, groups = q.plan(weight)
    seg = lexical.Segment(lengths, terms, docs, tfs, weight, size, int(lengths.sum()), pairs)
    score = np.bincount(docs, seg.impact, size).astype(np.int64)
    for p, (a, b) in enumerate(pairs):
        both = set(docs[terms == a]) & set(docs[terms == b])
        assert seg.joint[p] == max([0, *(int(seg.impact[(terms == a) & (docs == d)][0] + seg.impact[(terms == b) & (docs == d)][0]) for d in both)])
    apart = np.column_stack([np.arange(n_terms), np.full((n_terms, 2), -1)])
    for least in (0, 1, *np.sort(score)[[5, 200, 350, 390, 399]].tolist(), int(score.max()) + 1):
        d, s, _ = seg.search(groups[0], least)
        want = np.flatnonzero(score >= max(1, least))
        assert d.tolist() == want.tolist() and s.tolist() == score[want].tolist()
        assert seg.search(apart, least)[0].tolist() == want.tolist()


def test_terms_that_never_meet_are_skipped_as_a_pair():
    """Two rare terms in different documents: their single maxima reach the threshold together, their pair's does not."""
    seg = lexical.Segment(np.full(4, 10), np.array([0, 0, 1, 1]), np.array([0, 1, 2, 3]), np.ones(4, np.int64),
                          np.array([1000, 1000]), 4, 40, np.array([[0, 1]]))
    least = int(seg.high.sum())
    assert seg.joint.tolist() == [0]
    assert seg.search(np.array([[0, 1, 0]]), least)[2] == 0 < seg.search(np.array([[0, -1, -1], [1, -1, -1]]), least)[2]


def test_lm_training_reads_every_token():
    """The blocks that go to training hold all tokens of all texts, also of words across block borders, in one round each."""
    import types

    import pyarrow as pa

    texts = ["ab cd " * 3000, "x" * 20000 + " y", "", "one two"]
    words = words_of([1, 1], 2)
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([5, 6, 7, 8], pa.int64())], names=["text", "key"])
    out = pa.Table.from_batches(list(gatedlm._numbers(types.SimpleNamespace(value=words), 4, 3)(iter([batch]))))
    assert sum(map(len, out["ids"].to_pylist())) == sum(len(t.split()) + 1 for t in texts)
    assert set(out["round"].to_pylist()) <= {0, 1, 2}


def test_lm_works_on_many_documents_at_once():
    """Blocks for training are cut for all documents of a chunk together, and documents of several batches are scored side by side."""
    import types

    import pyarrow as pa

    words = words_of([1, 1], 2)
    texts, keys = ["a b"] * 500, list(range(500))
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(keys, pa.int64())], names=["text", "key"])
    out = list(gatedlm._numbers(types.SimpleNamespace(value=words), 4, 3)(iter([batch])))
    assert len(out) == 1 and out[0].num_rows == 500
    model, calls = gatedlm.GatedLM.fresh(words, embed=3, hidden=4, size=2), []
    whole = types.SimpleNamespace(score=lambda y, off: calls.append(len(off) - 1) or model.score(y, off))
    batches = [pa.RecordBatch.from_arrays([pa.array([i, i + 1]), pa.array([t, "é w " * i])], names=["rid", "text"]) for i, t in ((0, "a b"), (2, None), (4, ""))]
    out = pa.Table.from_batches(list(gatedlm._score(types.SimpleNamespace(value=(words, whole)))(iter(batches)))).to_pylist()
    end = words.find(np.array([gatedlm.END]))[0]
    assert calls == [6] and [r["rid"] for r in out] == [0, 1, 2, 3, 4, 5]
    assert [r["n_tokens"] for r in out] == [3, 1, 1, 5, 1, 9]
    assert all(math.isclose(r["model_ln"], model.score(np.append(np.full(r["n_tokens"] - 1, 2), end), np.array([0, r["n_tokens"]]))[0], rel_tol=1e-5) for r in out)


def test_lm_pass_learns_from_every_token(monkeypatch):
    """Also from those that lanes of equal length leave over."""
    w = words_of([50, 40, 30, 9, 7, 5, 2], 6)
    for n, lanes, window in ((103, 4, 5), (7, 4, 5), (100, 4, 5), (3, 32, 20), (1, 4, 5)):
        m, seen = gatedlm.GatedLM.fresh(w, embed=3, hidden=4, size=2), []
        real = m.gradients
        monkeypatch.setattr(m, "gradients", lambda x, y, go, h: seen.append((x.copy(), y.copy(), go.copy())) or real(x, y, go, h))
        y = np.random.default_rng(n).integers(0, 7, n)
        m.train([y[:n // 3], y[n // 3:]], 0.01, lanes, window)
        assert sorted(np.concatenate([v.ravel() for _, v, _ in seen])) == sorted(y)
        assert sum((go == 0).sum() for *_, go in seen) == 1 + (n // 3 > 0)
        x = np.concatenate(([m.n + 1], y[:-1]))
        x[n // 3] = m.n + 1
        assert sorted(np.concatenate([v.ravel() for v, *_ in seen])) == sorted(x)


def test_lm_rounds_read_all_tokens_of_a_large_corpus(spark, monkeypatch):
    def counts(model, rate, lanes=32):
        def run(pdf):
            import pandas as pd

            v = model.value.flat().astype(np.float64) + sum(map(len, pdf["ids"]))
            v = np.pad(v, (0, -len(v) % 4096)).reshape(-1, 4096)
            return pd.DataFrame({"block": np.arange(len(v), dtype=np.int32), "v": list(v)})

        return run

    monkeypatch.setattr(gatedlm, "WIDE_TOKENS", 20)
    monkeypatch.setattr(gatedlm, "_round", counts)
    words = words_of([30, 60], 2)
    texts = spark.createDataFrame([("a b", i) for i in range(30)], "text string, key bigint")
    gain = gatedlm.fit(texts, words).flat() - gatedlm.GatedLM.fresh(words).flat()
    assert np.allclose(gain[:1000], 90 * len(gatedlm.RATES), atol=1e-3)  # of the embedding
