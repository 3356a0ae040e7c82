"""Queries over metrics and probability calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabtext.operators import calibrate as K
from tabtext.operators import metrics as ME
from tabtext.operators import tuning as TU
from tabtext.plans import sql as S
from tabtext.plans.registry import query
from tabtext.sources import standins as si

R6 = 6
FOCUS_IDS = [1, 3]
_PRED = """
pred AS (SELECT case_id, split, y, list_position(p, list_max(p)) - 1 AS pred FROM proba)"""


def _pred(spark, sf_dir):
    p = si.proba(spark, sf_dir)
    return p.select("case_id", "split", "y", K.argmax(F.col("p")).alias("pred"))


@query("argmax_class", S.with_(S.CASES, S.PROBA, _PRED) + "\nSELECT case_id, CAST(pred AS INTEGER) AS pred FROM pred")
def argmax_class(spark, sf_dir):
    """First arg-max class per case."""
    return _pred(spark, sf_dir).select("case_id", "pred")


@query("confusion", S.with_(S.CASES, S.PROBA, _PRED, S.metrics_ctes("pred", "split")) + """
SELECT split, CAST(y AS INTEGER) AS y, CAST(pred AS INTEGER) AS pred, CAST(n AS BIGINT) AS n FROM conf""")
def confusion(spark, sf_dir):
    """Confusion counts per split."""
    return ME.confusion(_pred(spark, sf_dir), group_cols=["split"])


def _summary(spark, sf_dir):
    return ME.summary(ME.confusion(_pred(spark, sf_dir), group_cols=["split"]), ["split"], FOCUS_IDS)


_SUMM = S.with_(S.CASES, S.PROBA, _PRED, S.metrics_ctes("pred", "split"))


@query("metric_accuracy", _SUMM + "\nSELECT split, round(accuracy, 6) AS accuracy FROM score")
def metric_accuracy(spark, sf_dir):
    """Accuracy per split."""
    return _summary(spark, sf_dir).select("split", F.round("accuracy", R6).alias("accuracy"))


@query("metric_f1", _SUMM + """
SELECT split, round(micro_f1, 6) AS micro_f1, round(macro_f1, 6) AS macro_f1, round(weighted_f1, 6) AS weighted_f1
FROM score""")
def metric_f1(spark, sf_dir):
    """Micro, macro (labels of truth or prediction) and weighted F1."""
    s = _summary(spark, sf_dir)
    return s.select("split", *[F.round(c, R6).alias(c) for c in ("micro_f1", "macro_f1", "weighted_f1")])


@query("focus_recall", _SUMM + "\nSELECT split, round(focus_recall, 6) AS focus_recall FROM score")
def focus_recall(spark, sf_dir):
    """E5: mean recall of the focus classes (absent class -> 0)."""
    return _summary(spark, sf_dir).select("split", F.round("focus_recall", R6).alias("focus_recall"))


@query("blend_score", _SUMM + "\nSELECT split, round(blend, 6) AS blend FROM score")
def blend_score(spark, sf_dir):
    """0.45 micro-F1 + 0.35 weighted-F1 + 0.20 focus recall."""
    return _summary(spark, sf_dir).select("split", F.round("blend", R6).alias("blend"))


@query("score_split", _SUMM + """
SELECT split, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS f1_macro, round(weighted_f1, 6) AS f1_weighted
FROM score""")
def score_split(spark, sf_dir):
    """Accuracy, macro-F1, weighted-F1 per split."""
    s = _summary(spark, sf_dir)
    return s.select("split", F.round("accuracy", R6).alias("accuracy"), F.round("macro_f1", R6).alias("f1_macro"),
                    F.round("weighted_f1", R6).alias("f1_weighted"))


@query("class_report", _SUMM + """
SELECT split, CAST(cls AS VARCHAR) AS row, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pc
UNION ALL
SELECT split, 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pc GROUP BY split
UNION ALL
SELECT split, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM pc GROUP BY split
UNION ALL
SELECT split, 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM pc GROUP BY split""")
def class_report(spark, sf_dir):
    """Per-class precision / recall / F1 / support plus accuracy, macro
    and weighted average rows, per split."""
    r = ME.class_report(ME.confusion(_pred(spark, sf_dir), group_cols=["split"]), ["split"])
    return r.select("split", "row", *[F.round(c, R6).alias(c) for c in ("precision", "recall", "f1")], "support")


_SCALES = [1.0, 2.0, 1.0, 1.5]


@query("apply_scales", S.with_(S.CASES, S.PROBA, f"""
sc AS (SELECT case_id, list_transform(range(1, 5), lambda i: p[i] * ([1.0, 2.0, 1.0, 1.5]::DOUBLE[])[i]) AS a FROM proba),
nm AS (SELECT case_id, list_transform(a, lambda x: x / CASE WHEN list_sum(a) <= 0 THEN 1.0 ELSE list_sum(a) END) AS q FROM sc)""") + """
SELECT case_id, CAST(pos - 1 AS INTEGER) AS pos, round(v, 6) AS value
FROM (SELECT case_id, unnest(range(1, 5)) AS pos, unnest(q) AS v FROM nm)""")
def apply_scales(spark, sf_dir):
    """K1: probabilities times class scales, renormalised (long form)."""
    p = si.proba(spark, sf_dir)
    x = p.select("case_id", K.apply_scales(F.col("p"), _SCALES).alias("q"))
    return x.select("case_id", F.posexplode("q").alias("pos", "value")).withColumn("value", F.round("value", R6))


def _sweep_sql() -> str:
    grid = ", ".join(f"{g!r}::DOUBLE" for g in S.GRID)
    return S.with_(S.CASES, S.PROBA, f"""
grid AS (SELECT unnest([{grid}]) AS g, unnest(range(0, {len(S.GRID)})) AS gi),
sc AS (SELECT gi, g, y, list_transform(range(1, 5), lambda i: p[i] * CASE WHEN i = 2 THEN g ELSE 1.0 END) AS a
       FROM proba, grid),
nm AS (SELECT gi, y, list_transform(a, lambda x: x / CASE WHEN list_sum(a) <= 0 THEN 1.0 ELSE list_sum(a) END) AS q FROM sc),
pred AS (SELECT gi, y, list_position(q, list_max(q)) - 1 AS pred FROM nm)""", S.metrics_ctes("pred", "gi"))


@query("scale_sweep", _sweep_sql() + """
SELECT CAST(gi AS INTEGER) AS gi, g, round(blend, 6) AS score FROM score JOIN grid USING (gi)""")
def scale_sweep(spark, sf_dir):
    """K2/K3: blend score of every grid value for the scale of class 1, all
    31 values in one job."""
    p = si.proba(spark, sf_dir)
    s = K.sweep(p, [1.0, 1.0, 1.0, 1.0], 1, FOCUS_IDS)
    return s.select("gi", "g", F.round("score", R6).alias("score"))


@query("best_trial", _sweep_sql() + """
SELECT CAST(gi AS INTEGER) AS gi, g, round(blend, 6) AS score FROM score JOIN grid USING (gi)
ORDER BY blend DESC, gi ASC LIMIT 1""")
def best_trial(spark, sf_dir):
    """Best entry of a scored ledger - highest score, earliest on ties."""
    p = si.proba(spark, sf_dir)
    s = K.sweep(p, [1.0, 1.0, 1.0, 1.0], 1, FOCUS_IDS)
    b = s.orderBy(F.col("score").desc(), F.col("gi").asc()).limit(1)
    return b.select("gi", "g", F.round("score", R6).alias("score"))


def _blend_sql(src: str, scale: str, group: str) -> str:
    """Blend per ``group`` of ``src`` (y, p, ...), p[i] weighted by the SQL expression ``scale``."""
    return f"""(WITH sc AS (SELECT {group}, y, list_transform(range(1, 5), lambda i: p[i] * {scale}) AS a FROM {src}),
nm AS (SELECT {group}, y, list_transform(a, lambda x: x / CASE WHEN list_sum(a) <= 0 THEN 1.0 ELSE list_sum(a) END) AS q FROM sc),
pred AS (SELECT {group}, y, list_position(q, list_max(q)) - 1 AS pred FROM nm),
{S.metrics_ctes("pred", group)}
SELECT {group}, round(blend, 12) AS score FROM score)"""


def _tune_sql() -> str:
    """The coordinate ascent, one CTE pair per (round, class); a round without gain leaves the state as it is."""
    grid = ", ".join(f"{g!r}::DOUBLE" for g in S.GRID)
    ctes = [f"grid AS (SELECT unnest([{grid}]) AS g, unnest(range(0, {len(S.GRID)})) AS gi)",
            f"""st0 AS MATERIALIZED (SELECT [1.0, 1.0, 1.0, 1.0]::DOUBLE[] AS s, score
FROM {_blend_sql("(SELECT 0 AS one, y, p FROM proba)", "1.0", "one")})"""]
    k = 0
    for _ in range(4):
        for c in FOCUS_IDS:
            k += 1
            src = f"(SELECT gi, g, y, p, s FROM proba, grid, st{k - 1})"
            ctes.append(f"sw{k} AS MATERIALIZED {_blend_sql(src, f'CASE WHEN i = {c + 1} THEN g ELSE s[i] END', 'gi')}")
            new = ", ".join("b.g" if i == c else f"s[{i + 1}]" for i in range(4))
            ctes.append(f"""st{k} AS MATERIALIZED (
SELECT CASE WHEN b.score > st.score THEN [{new}] ELSE s END AS s, greatest(b.score, st.score) AS score
FROM st{k - 1} st, (SELECT g, score FROM sw{k} JOIN grid USING (gi) ORDER BY score DESC, gi LIMIT 1) b)""")
    return S.with_(S.CASES, S.PROBA, *ctes) + f"""
SELECT CAST(i - 1 AS INTEGER) AS cls, s[i] AS scale, round(score, 6) AS score
FROM st{k}, (SELECT unnest(range(1, 5)) AS i)"""


@query("tune_scales", _tune_sql())
def tune_scales(spark, sf_dir):
    """K4: coordinate ascent of the focus-class scales on the scored table."""
    p = si.proba(spark, sf_dir)
    scales, best, trace = K.tune_scales(p, 4, FOCUS_IDS)
    rows = [(i, float(s)) for i, s in enumerate(scales)]
    return spark.createDataFrame(rows, "cls int, scale double").withColumn("score", F.round(F.lit(best), R6))


TRIALS = 40


def _trial_sql() -> str:
    box = ", ".join(f"0.5 + 2.5 * {S.unit(repr('42'), 'trial', repr(f'scale_{c}'))} AS scale_{c}" for c in FOCUS_IDS)
    scale = " ".join(f"WHEN i = {c + 1} THEN scale_{c}" for c in FOCUS_IDS)
    return S.with_(S.CASES, S.PROBA, f"trials AS (SELECT trial, {box} FROM range({TRIALS}) t(trial))", f"""
ledger AS (SELECT trial, scale_1, scale_3, score FROM trials JOIN
{_blend_sql("proba, trials", f"CASE {scale} ELSE 1.0 END", "trial")} USING (trial)),
st AS (SELECT avg(score) AS m, stddev_pop(score) AS s FROM ledger),
top AS (SELECT trial AS t FROM ledger ORDER BY score DESC, trial LIMIT 1)""") + """
SELECT trial, round(scale_1, 6) AS scale_1, round(scale_3, 6) AS scale_3, round(score, 6) AS score,
       round((score - m) / CASE WHEN s < 1e-8 THEN 1.0 ELSE s END, 6) AS z, CAST(trial = t AS INTEGER) AS best
FROM ledger, st, top"""


@query("trial_search", _trial_sql())
def trial_search(spark, sf_dir):
    """40 random candidates of the focus-class scales scored by blend on the whole scored table in
    one job; ledger with standardised scores and the best trial."""
    led = TU.scale_search(si.proba(spark, sf_dir), TRIALS, 4, FOCUS_IDS)
    return led.select("trial", *[F.round(c, R6).alias(c) for c in ("scale_1", "scale_3", "score", "z")], "best")
