import random
from collections import Counter

from pyspark.sql import functions as F

from brute import apply_scales, argmax, f1_metrics, tune_scales
from tabtext.operators import calibrate as K
from tabtext.operators import metrics as ME
from tabtext.operators import sampling as SA
from tabtext.operators.ranking import row_number_within


def _labelled(spark, sizes):
    rows, i = [], 0
    for lab, n in sizes.items():
        for _ in range(n):
            rows.append((i, lab))
            i += 1
    return spark.createDataFrame(rows, "case_id bigint, label string")


def test_row_number_within_matches_window(spark):
    df = _labelled(spark, {"a": 500, "b": 7, "c": 1}).withColumn("h", F.md5(F.col("case_id").cast("string")))
    got = {r["case_id"]: r["rn"] for r in row_number_within(df, ["label"], ["h", "case_id"], num_partitions=6).collect()}
    rows = sorted(df.collect(), key=lambda r: (r["label"], r["h"], r["case_id"]))
    want, prev, k = {}, None, 0
    for r in rows:
        k = k + 1 if r["label"] == prev else 1
        prev = r["label"]
        want[r["case_id"]] = k
    assert got == want


def test_stratified_folds_balanced(spark):
    df = _labelled(spark, {"a": 103, "b": 9, "c": 2, "d": 50})
    out = SA.stratified_folds(df, k=5, seed=42).collect()
    assert len(out) == 164 and len({r["case_id"] for r in out}) == 164
    by = Counter((r["label"], r["fold"]) for r in out)
    for lab in "abcd":
        sizes = [by.get((lab, f), 0) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_upsample_counts_and_weights(spark):
    df = _labelled(spark, {"big": 60, "mid": 30, "r1": 4, "r2": 25, "r3": 0})
    up = SA.upsample_focus(df, ["r1", "r2", "r3", "absent"], seed=1)
    c = Counter(r["label"] for r in up.collect())
    med = int(sorted([60, 30, 4, 25])[1] / 2 + sorted([60, 30, 4, 25])[2] / 2)
    assert c["r1"] == max(3 * 4, med) and c["r2"] == max(3 * 25, med) and c["big"] == 60
    orig = {r["case_id"] for r in df.collect()}
    assert {r["case_id"] for r in up.collect()} <= orig
    assert SA.upsample_focus(df, []).count() == df.count()
    w = {r["label"]: r["weight"] for r in SA.balanced_weights(up).collect()}
    n, k = sum(c.values()), len(c)
    for lab, cnt in c.items():
        assert abs(w[lab] - n / (k * cnt)) < 1e-12


def test_metrics_match_brute_force(spark):
    rnd = random.Random(3)
    y = [rnd.choice([0, 0, 0, 1, 2]) for _ in range(200)]
    p = [v if rnd.random() < 0.7 else rnd.choice([0, 1, 3]) for v in y]  # 3 predicted, never true
    df = spark.createDataFrame(list(zip(y, p)), "y int, pred int")
    got = ME.summary(ME.confusion(df), [], [1, 2, 4]).first()
    want = f1_metrics(y, p, [1, 2, 4])
    for k, v in want.items():
        assert abs(got[k] - v) < 1e-12, k
    none = ME.summary(ME.confusion(df), [], []).first()
    assert abs(none["focus_recall"] - want["weighted_f1"]) < 1e-12
    rep = {r["row"]: r for r in ME.class_report(ME.confusion(df)).collect()}
    assert "3" in rep and rep["3"]["support"] == 0 and abs(rep["macro avg"]["f1"] - want["macro_f1"]) < 1e-12


def test_argmax_ties_and_zero_scales(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.0, 0.0, 0.0],)], "p array<double>")
    out = df.select(K.argmax(F.col("p")).alias("a"), K.apply_scales(F.col("p"), [0.0, 1.0, 2.0]).alias("q")).collect()
    assert [r["a"] for r in out] == [0, 0]
    assert out[1]["q"] == [0.0, 0.0, 0.0]


def test_tune_scales_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(120):
        y = rnd.choice([0, 0, 0, 1, 2, 3])
        raw = [rnd.random() + (0.4 if j == y else 0.0) for j in range(4)]
        s = sum(raw)
        rows.append((i, y, [v / s for v in raw]))
    df = spark.createDataFrame(rows, "case_id int, y int, p array<double>")
    got_scales, got_best, _ = K.tune_scales(df, 4, [1, 3])
    want_scales, want_best = tune_scales([r[1] for r in rows], [r[2] for r in rows], [1, 3], K.GRID)
    assert got_scales == want_scales and abs(got_best - want_best) < 1e-12
    s0, b0, _ = K.tune_scales(df, 4, [])
    assert s0 == [1.0] * 4
    base = f1_metrics([r[1] for r in rows], [argmax(apply_scales(r[2], [1.0] * 4)) for r in rows], [])["blend"]
    assert abs(b0 - base) < 1e-12


def test_upsample_wide_draws_the_same_rows(spark):
    rows = [(i, "big") for i in range(40)] + [(100 + i, "r1") for i in range(3)] + [(200 + i // 2, "r2") for i in range(4)]
    df = spark.createDataFrame(rows, "case_id int, label string").withColumn("x", F.col("case_id") * 2.0).checkpoint()
    for focus in (["r1", "r2", "absent"], []):
        a = sorted((r["case_id"], r["label"]) for r in SA.upsample_focus(df, focus, seed=3).collect())
        b = SA.upsample_wide(df, focus, seed=3).collect()
        assert a == sorted((r["case_id"], r["label"]) for r in b)
        assert all(r["x"] == 2.0 * r["case_id"] for r in b)
