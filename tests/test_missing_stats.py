import math
import random

import numpy as np

from tabtext.functions.fdist import f_sf
from tabtext.operators import missing as M
from tabtext.operators import stats as ST


def test_exact_median_narrowing_path_matches_numpy(spark):
    rnd = random.Random(7)
    rows = []
    for k in range(3):
        for i in range(300 + k):
            v = rnd.random() * 10 ** rnd.randint(-3, 3)
            rows.append((f"f{k}", None if i % 17 == 0 else v))
    rows += [("const", 2.5)] * 40 + [("dup", 1.0)] * 50 + [("dup", 2.0)] * 50 + [("empty", None)]
    df = spark.createDataFrame(rows, "feature string, value double")
    got = {r["feature"]: r["median"] for r in M.exact_medians(df, ["feature"], "value", cap=8, buckets=4).collect()}
    for f in {r[0] for r in rows}:
        vals = [v for k, v in rows if k == f and v is not None]
        want = float(np.median(vals)) if vals else None
        assert (got[f] is None) if want is None else abs(got[f] - want) < 1e-12, f


def test_exact_median_of_extreme_values(spark):
    inf, big = float("inf"), 1.5e308
    sets = {"inf": [inf, -inf, 1.0], "infs": [inf, inf, -inf, 2.0, 3.0], "huge": [big, -big, big, -big, 1.0, 2.0],
            "low": [-inf, -inf, 5.0], "both": [-inf, inf], "top": [big, big * 1.1], "scale": [10.0 ** e for e in range(-300, 300, 7)]}
    rows = [(k, v) for k, vs in sets.items() for v in vs]
    df = spark.createDataFrame(rows, "feature string, value double")
    for cap, buckets in ((100, 1024), (1, 4)):
        got = {r["feature"]: r["median"] for r in M.exact_medians(df, ["feature"], "value", cap=cap, buckets=buckets).collect()}
        for k, vs in sets.items():
            s = sorted(vs)
            a, b = s[(len(s) - 1) // 2], s[len(s) // 2]
            want = a if a == b else a / 2 + b / 2
            assert got[k] == want or math.isnan(got[k]) and math.isnan(want) or abs(got[k] - want) <= 1e-15 * abs(want), k


def test_whole_number_columns_take_fractional_medians(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "x int")
    out = M.fill_missing(df, M.median_map(df, ["x"]), [], None)
    assert sorted(r["x"] for r in out.collect()) == [1.0, 2.0, 2.5, 3.0, 4.0]


def test_null_rates_fill_and_indicators(spark):
    df = spark.createDataFrame([(1, "train", 1.0, None, None), (2, "train", None, "a", "r"), (3, "val", None, None, None),
                                (4, "train", 3.0, None, "s")], "case_id int, split string, x double, s string, report string")
    rates = M.null_rate_map(df.filter("split = 'train'"), ["x", "s"])
    assert abs(rates["x"] - 1 / 3) < 1e-12 and abs(rates["s"] - 2 / 3) < 1e-12
    assert M.sparse_columns(rates, 0.40) == ["s"]
    ind = M.add_missing_indicators(df, ["x", "absent"])
    assert {r["case_id"]: r["x__is_missing"] for r in ind.collect()} == {1: 0, 2: 1, 3: 1, 4: 0}
    meds = M.median_map(df.filter("split = 'train'"), ["x"])
    out = {r["case_id"]: r for r in M.fill_missing(df, meds, ["s"]).collect()}
    assert out[3]["x"] == 2.0 and out[3]["s"] == "Unknown" and out[3]["report"] == ""


def _f_brute(groups):
    allv = [v for g in groups for v in g]
    n, k = len(allv), len(groups)
    gm = sum(allv) / n
    ssb = sum(len(g) * (sum(g) / len(g) - gm) ** 2 for g in groups)
    ssw = sum(sum((v - sum(g) / len(g)) ** 2 for v in g) for g in groups)
    return (ssb / (k - 1)) / (ssw / (n - k))


def test_anova_with_median_fill(spark):
    rows = [(i, "f", c, v) for i, (c, v) in enumerate(
        [("a", 1.0), ("a", 2.0), ("a", None), ("b", 5.0), ("b", 6.5), ("c", 3.0), ("c", None), ("c", 4.0)])]
    rows += [(100 + i, "const", "a" if i % 2 else "b", 1.0) for i in range(6)]
    df = spark.createDataFrame(rows, "case_id int, feature string, label string, value double")
    out = {r["feature"]: r for r in ST.anova(df).collect()}
    med = float(np.median([1, 2, 5, 6.5, 3, 4]))
    want = _f_brute([[1, 2, med], [5, 6.5], [3, med, 4]])
    assert abs(out["f"]["f_stat"] - want) < 1e-9
    assert math.isnan(out["const"]["f_stat"]) and math.isnan(out["const"]["p_value"])
    assert ST.anova_keep(ST.anova(df), ["f", "const"], 0.05, 3) == [c for c in ["f"] if out["f"]["p_value"] <= 0.05]
    assert ST.anova_keep(ST.anova(df), ["f", "const"], 0.05, 1) == ["f", "const"]


def test_f_distribution_tail():
    # P(F(1, d) > t^2) equals the two-sided t tail; F(2, 2) tail is 1/(1+f)
    assert abs(f_sf(3.0, 2, 2) - 1 / 4) < 1e-12
    assert abs(f_sf(1.0, 2, 2) - 0.5) < 1e-12
    # F(2, d2) tail = (1 + 2f/d2)^(-d2/2)
    for f, d2 in [(0.5, 7), (4.2, 30), (12.0, 3)]:
        assert abs(f_sf(f, 2, d2) - (1 + 2 * f / d2) ** (-d2 / 2)) < 1e-10
    assert f_sf(float("inf"), 3, 9) == 0.0 and math.isnan(f_sf(float("nan"), 3, 9))


def test_f_tail_of_many_rows():
    """A billion rows: more than ten thousand terms, and the limit of the chi-squared tail."""
    import math

    from tabtext.functions.fdist import betainc, f_sf

    assert abs(f_sf(3.0, 2.0, 1e9) - math.exp(-3.0)) < 1e-6
    assert abs(betainc(5e8, 5e8, 0.5) - 0.5) < 1e-5
