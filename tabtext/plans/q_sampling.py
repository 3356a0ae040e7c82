"""Queries over folds, upsampling, weights, splits and orderings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabtext.operators import calibrate as K
from tabtext.operators import metrics as ME
from tabtext.operators import sampling as SA
from tabtext.plans import sql as S
from tabtext.plans.registry import query
from tabtext.sources import standins as si

R6 = 6
FOCUS = list(si.FOCUS_CLASSES)
_FOLD_CTE = f"""
lab AS (SELECT case_id, split, label FROM cases WHERE label IS NOT NULL AND split IN ('train', 'val')),
folds AS (SELECT case_id, label,
                 CAST((row_number() OVER (PARTITION BY label ORDER BY {S.u32("'42'", 'case_id')}, case_id) - 1) % 5 AS INTEGER)
                   AS fold FROM lab)"""


@query("stratified_fold", S.with_(S.CASES, _FOLD_CTE) + "\nSELECT case_id, label, fold FROM folds")
def stratified_fold(spark, sf_dir):
    """B1: 5 stratified folds (seed 42) over labelled train+val cases."""
    c = si.cases(spark, sf_dir).filter("label IS NOT NULL AND split IN ('train', 'val')").select("case_id", "label")
    return SA.stratified_folds(c, k=5, seed=42)


_UP_SQL = S.with_(S.CASES, f"""
tr AS (SELECT case_id, label FROM cases WHERE split = 'train' AND label IS NOT NULL),
cnt AS (SELECT label, count(*) AS n FROM tr GROUP BY label),
med AS (SELECT CAST(floor(median(n)) AS BIGINT) AS m FROM cnt),
need AS (SELECT label, n, greatest(3 * n, m) - n AS extra FROM cnt, med
         WHERE label IN ('class_1', 'class_3', 'class_9') AND greatest(3 * n, m) - n > 0),
draws AS (SELECT label, n, unnest(range(1, extra + 1)) AS j FROM need),
picks AS (SELECT label, j, ({S.u32("'42'", 'label', 'j')} % n) + 1 AS rn FROM draws),
ranked AS (SELECT case_id, label, row_number() OVER (PARTITION BY label ORDER BY case_id) AS rn FROM tr)""") + """
SELECT case_id, label, CAST(0 AS BIGINT) AS copy FROM tr
UNION ALL
SELECT r.case_id, r.label, CAST(p.j AS BIGINT) AS copy FROM picks p JOIN ranked r USING (label, rn)"""


@query("upsample_focus", _UP_SQL)
def upsample_focus(spark, sf_dir):
    """B2: focus classes of the train split topped up with replacement to
    max(3 n, median class count); copy 0 = original row."""
    tr = si.cases(spark, sf_dir).filter("split = 'train' AND label IS NOT NULL").select("case_id", "label")
    return SA.upsample_focus(tr, FOCUS, seed=42)


@query("balanced_weight", S.with_(S.CASES, """
tr AS (SELECT case_id, label FROM cases WHERE split = 'train' AND label IS NOT NULL),
cnt AS (SELECT label, count(*) AS n FROM tr GROUP BY label),
tot AS (SELECT sum(n) AS nn, count(*) AS k FROM cnt)""") + """
SELECT tr.case_id, tr.label, round(nn / (k * n), 6) AS weight FROM tr JOIN cnt USING (label), tot""")
def balanced_weight(spark, sf_dir):
    """Balanced class weight N / (K n_k) per train row."""
    tr = si.cases(spark, sf_dir).filter("split = 'train' AND label IS NOT NULL").select("case_id", "label")
    return SA.balanced_weights(tr).withColumn("weight", F.round("weight", R6))


@query("hash_split", f"SELECT doc_id AS case_id, {S.split_case('doc_id')} AS split FROM documents")
def hash_split(spark, sf_dir):
    """md5-bucket train / val / test split of the documents."""
    d = si.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("case_id"))
    return SA.assign_split(d)


@query("shuffle_md5", f"""
SELECT doc_id AS case_id, CAST(row_number() OVER (ORDER BY {S.u32("'42'", 'doc_id')}, doc_id) AS BIGINT) AS position
FROM documents""")
def shuffle_md5(spark, sf_dir):
    """Seeded permutation of all cases as a global position."""
    d = si.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("case_id"))
    return SA.seeded_order(d, seed=42)


@query("fold_summary", S.with_(S.CASES, S.PROBA, _FOLD_CTE, """
pred AS (SELECT f.fold, p.y, list_position(p.p, list_max(p.p)) - 1 AS pred FROM folds f JOIN proba p USING (case_id))""",
                               S.metrics_ctes("pred", "fold")) + """
SELECT round(avg(blend), 6) AS mean_score, round(stddev_pop(blend), 6) AS std_score FROM score""")
def fold_summary(spark, sf_dir):
    """Mean / population std of the per-fold blend score of arg-max
    predictions over 5 stratified folds."""
    c = si.cases(spark, sf_dir).filter("label IS NOT NULL AND split IN ('train', 'val')").select("case_id", "label")
    folds = SA.stratified_folds(c, k=5, seed=42)
    p = si.proba(spark, sf_dir).select("case_id", "y", "p")
    x = folds.join(p, "case_id").select("fold", "y", K.argmax(F.col("p")).alias("pred"))
    per_fold = ME.summary(ME.confusion(x, group_cols=["fold"]), ["fold"], [1, 3])
    s = ME.fold_summary(per_fold, "blend")
    return s.select(F.round("mean_score", R6).alias("mean_score"), F.round("std_score", R6).alias("std_score"))
