"""Queries over aggregations, missing-data rules and ANOVA."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabtext.operators import missing as M
from tabtext.operators import stats as ST
from tabtext.plans import frames as FR
from tabtext.plans import sql as S
from tabtext.plans.registry import query
from tabtext.sources import standins as si

R6 = 6
_TRAIN_CTE = "rtrain AS (SELECT * FROM rframe WHERE split = 'train')"
_TRAIN_LONG = S.unpivot("rtrain")


@query("median_cols", S.with_(S.RAD_FRAME, _TRAIN_CTE) + f"""
SELECT feature AS column, median(value) AS median FROM {_TRAIN_LONG} GROUP BY feature""")
def median_cols(spark, sf_dir):
    """G1: exact median of every radiomics column over the train split."""
    fr = FR.radiomics_frame(spark, sf_dir).filter("split = 'train'")
    return M.column_medians(fr, FR.RAD_COLS)


@query("null_rate", S.with_(S.RAD_FRAME, _TRAIN_CTE) + f"""
SELECT feature AS column, round(avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate
FROM {_TRAIN_LONG} GROUP BY feature""")
def null_rate(spark, sf_dir):
    """Null rate of every radiomics column over the train split (one pass)."""
    fr = FR.radiomics_frame(spark, sf_dir).filter("split = 'train'")
    return M.null_rates(fr, FR.RAD_COLS).withColumn("null_rate", F.round("null_rate", R6))


def _fill_sql() -> str:
    cols = ", ".join(f"coalesce(f.{c}, m.{c}) AS {c}" for c in S.RAD_COLS)
    meds = ", ".join(f"median({c}) AS {c}" for c in S.RAD_COLS)
    return S.with_(S.CASE_FRAME, f"m AS (SELECT {meds} FROM frame WHERE split = 'train')") + f"""
SELECT f.case_id, f.split, f.label, coalesce(f.report, '') = f.report AS had_report,
       CAST(length(coalesce(f.report, '')) AS BIGINT) AS report_len,
       CAST(coalesce(CASE WHEN f.case_id % 3 > 0 THEN f.case_id END, i.x) AS DOUBLE) AS whole, coalesce(f.label, 'Unknown') AS grade, {cols}
FROM frame f, m, (SELECT median(case_id) AS x FROM frame WHERE split = 'train' AND case_id % 3 > 0) i"""


@query("fill_train_median", _fill_sql())
def fill_train_median(spark, sf_dir):
    """Numerics (a whole-number one among them) filled with the train
    median in all splits, a string with 'Unknown', report with '', label
    untouched. Reports become their lengths before any join."""
    had = (F.coalesce(F.col("report"), F.lit("")) == F.col("report")).alias("had_report")
    cases = M.fill_missing(si.cases(spark, sf_dir, with_label=False).select("*", had), {}) \
        .select("case_id", "split", "had_report", F.char_length("report").cast("bigint").alias("report_len"))
    fr = cases.join(si.labels_of(spark, sf_dir), "case_id", "left") \
        .join(FR.radiomics_merged(spark, sf_dir), "case_id", "left") \
        .withColumn("whole", F.when(F.col("case_id") % 3 > 0, F.col("case_id"))).withColumn("grade", F.col("label"))
    meds = M.median_map(fr.filter("split = 'train'"), ["whole", *FR.RAD_COLS])
    return M.fill_missing(fr, meds, string_cols=["grade"]) \
        .select("case_id", "split", "label", "had_report", "report_len", "whole", "grade", *FR.RAD_COLS)


_RATES_CTE = f"""
rates AS (SELECT feature, avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) AS r FROM {_TRAIN_LONG} GROUP BY feature)"""


@query("drop_sparse_cols", S.with_(S.RAD_FRAME, _TRAIN_CTE, _RATES_CTE) + """
SELECT feature AS column, round(r, 6) AS null_rate, CAST(r > 0.40 AS INTEGER) AS dropped FROM rates""")
def drop_sparse_cols(spark, sf_dir):
    """Radiomics columns with train null rate > 0.40 are dropped."""
    fr = FR.radiomics_frame(spark, sf_dir)
    rates = M.null_rate_map(fr.filter("split = 'train'"), FR.RAD_COLS)
    drop = set(M.sparse_columns(rates, 0.40))
    rows = [(c, round(float(rates[c]), R6), int(c in drop)) for c in FR.RAD_COLS]
    return spark.createDataFrame(rows, "column string, null_rate double, dropped int")


@query("missing_indicators", S.with_(S.RAD_FRAME, _TRAIN_CTE, _RATES_CTE) + f"""
SELECT l.case_id, l.split, l.feature AS column, CAST(l.value IS NULL AS INTEGER) AS is_missing
FROM {S.unpivot("rframe")} l JOIN rates USING (feature)
WHERE r <= 0.40 AND r > 0.10""")
def missing_indicators(spark, sf_dir):
    """For kept columns with train null rate > 0.10, the 0/1 indicator
    in every split (long form: case, column, is_missing)."""
    fr = FR.radiomics_frame(spark, sf_dir)
    rates = M.null_rate_map(fr.filter("split = 'train'"), FR.RAD_COLS)
    kept = [c for c in FR.RAD_COLS if c not in set(M.sparse_columns(rates, 0.40))]
    ind = M.indicator_columns({c: rates[c] for c in kept}, 0.10)
    if not ind:
        return spark.createDataFrame([], "case_id bigint, split string, column string, is_missing int")
    x = M.add_missing_indicators(fr.select("case_id", "split", *ind), ind)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__is_missing").alias("is_missing")) for c in ind])
    return x.select("case_id", "split", F.inline(arr))


# ------------------------------------------------------ class statistics ----

_CNT = S.with_(S.CASES, """
cnt AS (SELECT split, label, CAST(count(*) AS BIGINT) AS n FROM cases WHERE label IS NOT NULL GROUP BY ALL)""")


@query("class_hist", _CNT + "\nSELECT split, label, n FROM cnt")
def class_hist(spark, sf_dir):
    """Class histogram per split."""
    return ST.class_counts(si.cases(spark, sf_dir), "label", ["split"])


@query("n_classes", _CNT + "\nSELECT split, CAST(count(*) AS BIGINT) AS n_classes, "
       "CAST(max(CAST(substr(label, 7) AS INTEGER)) + 1 AS INTEGER) AS max_code_plus_one FROM cnt GROUP BY split")
def n_classes(spark, sf_dir):
    """Number of distinct labels and max class code + 1 per split."""
    cnt = ST.class_counts(si.cases(spark, sf_dir), "label", ["split"])
    code = F.regexp_extract("label", r"(\d+)$", 1).cast("int")
    return cnt.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("n_classes"),
                                    (F.max(code) + 1).cast("int").alias("max_code_plus_one"))


@query("class_median", _CNT + "\nSELECT split, CAST(floor(median(n)) AS BIGINT) AS median_count FROM cnt GROUP BY split")
def class_median(spark, sf_dir):
    """Median of the non-zero class counts, truncated, per split."""
    s = ST.class_summary(ST.class_counts(si.cases(spark, sf_dir), "label", ["split"]), ["split"])
    return s.select("split", "median_count")


@query("imbalance_ratio", _CNT + "\nSELECT split, round(max(n) / min(n), 6) AS imbalance_ratio FROM cnt GROUP BY split")
def imbalance_ratio(spark, sf_dir):
    """Largest / smallest class count per split."""
    s = ST.class_summary(ST.class_counts(si.cases(spark, sf_dir), "label", ["split"]), ["split"])
    return s.select("split", F.round("imbalance_ratio", R6).alias("imbalance_ratio"))


# ----------------------------------------------------------------- ANOVA ----

_ANOVA_SQL = S.with_(S.RAD_FRAME, f"""
rlab AS (SELECT * FROM rframe WHERE split = 'train' AND label IS NOT NULL),
lg AS (SELECT * FROM {S.unpivot("rlab")}),
med AS (SELECT feature, median(value) AS m FROM lg GROUP BY feature),
x AS (SELECT feature, label, coalesce(value, m) AS v FROM lg JOIN med USING (feature)),
cls AS (SELECT feature, label, count(*) AS nk, avg(v) AS mk FROM x GROUP BY ALL),
grand AS (SELECT feature, sum(nk) AS n, count(*) AS k, sum(nk * mk) / sum(nk) AS g FROM cls GROUP BY feature),
ssw AS (SELECT x.feature, sum((x.v - cls.mk) * (x.v - cls.mk)) AS ssw FROM x JOIN cls USING (feature, label) GROUP BY x.feature),
ssb AS (SELECT feature, sum(nk * (mk - g) * (mk - g)) AS ssb FROM cls JOIN grand USING (feature) GROUP BY feature)""") + """
SELECT feature, CAST(n AS BIGINT) AS n, CAST(k AS BIGINT) AS k, round((ssb / (k - 1)) / (ssw / (n - k)), 6) AS f_stat
FROM grand JOIN ssb USING (feature) JOIN ssw USING (feature)"""


def _anova_stats(spark, sf_dir):
    fr = FR.radiomics_frame(spark, sf_dir).filter("split = 'train'")
    long = M.to_long(fr, FR.RAD_COLS, ["case_id", "label"], name="feature")
    return ST.anova(long)


@query("anova_f", _ANOVA_SQL)
def anova_f(spark, sf_dir):
    """One-way ANOVA F per radiomics feature on labelled train rows,
    nulls filled with the feature median first."""
    return _anova_stats(spark, sf_dir).select("feature", "n", "k", F.round("f_stat", R6).alias("f_stat"))


# Tail of the F distribution by Simpson's rule: with x = d1 f / (d1 f + d2), a = d1 / 2, b = d2 / 2 and
# t = 1 - exp(-v / b) the upper tail is the integral of (1 - exp(-v / b))^(a - 1) exp(-v) / (b B(a, b)) from
# v0 = -b ln(1 - x) on; 60 beyond v0 the integrand is below 1e-26 of its start.
_TAIL_STEPS = 4000
_ANOVA_SELECT_SQL = f"""
WITH st AS ({_ANOVA_SQL.replace("round((ssb / (k - 1)) / (ssw / (n - k)), 6)", "(ssb / (k - 1)) / (ssw / (n - k))")}),
par AS (SELECT feature, f_stat, (k - 1) / 2.0 AS a, (n - k) / 2.0 AS b FROM st),
lo AS (SELECT *, b * ln(1 + a * f_stat / b) AS v0, lgamma(a) + lgamma(b) - lgamma(a + b) + ln(b) AS ln_den FROM par),
pts AS (SELECT feature, CASE WHEN i = 0 OR i = {_TAIL_STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w,
               v0 + 60.0 * i / {_TAIL_STEPS} AS v, a, b, ln_den
        FROM lo, range({_TAIL_STEPS + 1}) r(i)),
tail AS (SELECT feature, 20.0 / {_TAIL_STEPS} * sum(w * exp((a - 1) * ln(1 - exp(-v / b)) - v - ln_den)) AS p
         FROM pts GROUP BY feature)
SELECT feature, round(f_stat, 6) AS f_stat, round(p, 9) AS p_value, CAST(p <= 0.05 AS INTEGER) AS keep
FROM par JOIN tail USING (feature)"""


@query("anova_select", _ANOVA_SELECT_SQL)
def anova_select(spark, sf_dir):
    """F1: ANOVA filter - features with finite p <= 0.05 are kept (p from the F distribution)."""
    st = _anova_stats(spark, sf_dir)
    return st.select("feature", F.round("f_stat", R6).alias("f_stat"), F.round("p_value", 9).alias("p_value"),
                     (F.col("p_value") <= 0.05).cast("int").alias("keep"))
