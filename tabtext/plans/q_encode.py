"""Queries over encoding, vector assembly and selection helpers
(V1, V6-V9, P13, P15, J5, O2, G12)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabtext.operators import calibrate as K
from tabtext.operators import encode as EN
from tabtext.operators import tfidf as tf
from tabtext.plans import frames as FR
from tabtext.plans import q_stats
from tabtext.plans import sql as S
from tabtext.plans.registry import query
from tabtext.sources import standins as si

R6 = 6

_ONEHOT_SQL = S.with_(S.CLINICAL, """
lv AS (SELECT DISTINCT 'c_mktsegment' AS col, c_mktsegment AS level FROM clinical WHERE c_mktsegment IS NOT NULL
       UNION SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM clinical WHERE o_orderpriority IS NOT NULL),
ix AS (SELECT col, level, row_number() OVER (PARTITION BY col ORDER BY level) - 1 AS r FROM lv),
off AS (SELECT 'c_mktsegment' AS col, 2 AS o
        UNION ALL SELECT 'o_orderpriority', 2 + (SELECT count(*) FROM ix WHERE col = 'c_mktsegment')),
vals AS (SELECT case_id, 'c_mktsegment' AS col, c_mktsegment AS level FROM clinical
         UNION ALL SELECT case_id, 'o_orderpriority', o_orderpriority FROM clinical)""") + """
SELECT v.case_id, v.col || '_' || v.level AS feature, CAST(off.o + ix.r AS INTEGER) AS idx
FROM vals v JOIN ix USING (col, level) JOIN off USING (col)"""


@query("one_hot", _ONEHOT_SQL)
def one_hot(spark, sf_dir):
    """V1: dummies of every string column with levels from all splits,
    numerics first; the non-zero dummy entries per case (name, index)."""
    clin = si.clinical(spark, sf_dir)
    model = EN.fit_one_hot(clin, exclude=["case_id", "split"])
    v = model.transform(clin, "tab")
    ent = tf.vector_entries(v, "tab", ["case_id"], "idx", "value").filter(F.col("idx") >= len(model.numeric))
    names = spark.createDataFrame(list(enumerate(model.feature_names)), "idx int, feature string")
    if len(model.feature_names) <= tf.BROADCAST_MAX_TERMS:  # checked bound on the dummy count
        names = F.broadcast(names)
    return ent.join(names, "idx").select("case_id", "feature", F.col("idx").cast("int").alias("idx"))


_LABELS_CTE = """
fit AS (SELECT list(label ORDER BY label) AS labels FROM (SELECT DISTINCT label FROM cases
        WHERE label IS NOT NULL AND split IN ('train', 'val')))"""


@query("label_encode", S.with_(S.CASES, _LABELS_CTE) + """
SELECT case_id, label, CAST(list_position(labels, label) - 1 AS INTEGER) AS y FROM cases, fit WHERE label IS NOT NULL""")
def label_encode(spark, sf_dir):
    """V9: label -> code in sorted order, fitted on train + val labels."""
    c = si.cases(spark, sf_dir)
    labels = EN.fit_labels(c.filter("split IN ('train', 'val')"))
    return EN.encode_labels(c.filter("label IS NOT NULL"), labels).select("case_id", "label", "y")


@query("label_decode", S.with_(S.CASES, S.PROBA, _LABELS_CTE) + """
SELECT case_id, labels[list_position(p, list_max(p))] AS pred_label FROM proba, fit""")
def label_decode(spark, sf_dir):
    """V9 inverse: arg-max codes back to label names."""
    c = si.cases(spark, sf_dir)
    labels = EN.fit_labels(c.filter("split IN ('train', 'val')"))
    p = si.proba(spark, sf_dir).select("case_id", K.argmax(F.col("p")).alias("pred"))
    return EN.decode_labels(p, labels).select("case_id", "pred_label")


@query("scale_no_center", S.with_(S.RAD_FRAME, f"""
lg AS (SELECT * FROM {S.unpivot("rframe")}),
sd AS (SELECT feature, stddev_pop(value) AS s FROM lg WHERE split = 'train' GROUP BY feature)""") + """
SELECT case_id, feature, round(CASE WHEN s IS NULL OR s = 0 THEN value ELSE value / s END, 6) AS value
FROM lg JOIN sd USING (feature)""")
def scale_no_center(spark, sf_dir):
    """V8: divide by the train population std (no centring), long form."""
    fr = FR.radiomics_frame(spark, sf_dir)
    stds = EN.fit_std_pop(fr.filter("split = 'train'"), FR.RAD_COLS)
    x = EN.scale_no_center(fr, stds)
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.round(c, R6).alias("value")) for c in FR.RAD_COLS])
    return x.select("case_id", F.inline(arr))


_SLICE = [0, 5, 17, 33, 63]


@query("vector_slice", f"""
SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, CAST(v AS DOUBLE) AS value FROM (
  SELECT vec_id, unnest(range(1, {len(_SLICE) + 1})) AS pos,
         unnest([{", ".join(f"embedding[{i + 1}]" for i in _SLICE)}]) AS v FROM embeddings)""")
def vector_slice(spark, sf_dir):
    """A vector restricted to an index list (VectorSlicer), long form."""
    v = array_to_vector(F.col("vec"))
    x = si.vectors(spark, sf_dir).withColumn("v", v)
    s = EN.slice_vector(x, "v", _SLICE, "s")
    return EN.to_float_array(s, "s", "a", "float64").select("vec_id", F.posexplode("a").alias("pos", "value"))


@query("vec_to_array", """
SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, CAST(CAST(v AS FLOAT) AS DOUBLE) AS value FROM (
  SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS pos, unnest(embedding) AS v FROM embeddings)""")
def vec_to_array(spark, sf_dir):
    """Vector -> float32 array (long form, values widened for output)."""
    x = si.vectors(spark, sf_dir).withColumn("v", array_to_vector(F.col("vec")))
    a = EN.to_float_array(x, "v", "a", "float32")
    return a.select("vec_id", F.posexplode("a").alias("pos", "v")).select(
        "vec_id", "pos", F.col("v").cast("double").alias("value"))


@query("topk_importance", q_stats._ANOVA_SQL + """
ORDER BY f_stat DESC, feature ASC LIMIT 20""")
def topk_importance(spark, sf_dir):
    """O2: the top-20 features of a score table (ANOVA F), largest first,
    ties by name."""
    st = q_stats._anova_stats(spark, sf_dir)
    top = st.orderBy(F.col("f_stat").desc(), F.col("feature").asc()).limit(20)
    return top.select("feature", "n", "k", F.round("f_stat", R6).alias("f_stat"))


@query("mean_pool", """
SELECT label, CAST(pos - 1 AS INTEGER) AS pos, round(avg(CAST(v AS DOUBLE)), 6) AS value FROM (
  SELECT label, unnest(range(1, len(embedding) + 1)) AS pos, unnest(embedding) AS v FROM embeddings)
GROUP BY label, pos""")
def mean_pool(spark, sf_dir):
    """Plain mean over all vectors of a group, per position."""
    e = si.table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "v"))
    return (e.groupBy("label", "pos").agg(F.round(F.avg(F.col("v").cast("double")), R6).alias("value"))
            .select("label", F.col("pos").cast("int").alias("pos"), "value"))
