"""Confusion-matrix metrics.

The only pass over the data is ``groupBy(group..., y, pred).count()`` (map-side
combined, at most K^2 rows per group); every metric is then derived from that
small table with DataFrame operations, so metrics stay lazy and can be
computed for many groups (folds, grid values, splits) in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: blend weights of the reference's selection score ----
BLEND_WEIGHTS = {"micro": 0.45, "weighted": 0.35, "focus_recall": 0.20}
# ---- end of fixed values ----


def confusion(df: DataFrame, y: str = "y", pred: str = "pred", group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., y, pred, n)."""
    return (df.groupBy(*group_cols, F.col(y).alias("y"), F.col(pred).alias("pred"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def per_class(conf: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., cls, tp, fp, fn, support, precision, recall, f1) over the
    labels seen in truth or prediction; 0/0 -> 0."""
    g = list(group_cols)
    t = conf.select(*g, F.col("y").alias("cls"), F.col("n").alias("_t"),
                    F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0).alias("_tp"),
                    F.lit(0).cast("bigint").alias("_p"))
    p = conf.select(*g, F.col("pred").alias("cls"), F.lit(0).cast("bigint").alias("_t"),
                    F.lit(0).cast("bigint").alias("_tp"), F.col("n").alias("_p"))
    s = t.unionByName(p).groupBy(*g, "cls").agg(F.sum("_t").alias("support"), F.sum("_tp").alias("tp"),
                                                 F.sum("_p").alias("predicted"))
    fp = F.col("predicted") - F.col("tp")
    fn = F.col("support") - F.col("tp")
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    den = 2 * F.col("tp") + fp + fn
    f1 = F.when(den > 0, 2 * F.col("tp") / den).otherwise(0.0)
    return s.select(*g, "cls", "tp", fp.alias("fp"), fn.alias("fn"), F.col("support").cast("bigint").alias("support"),
                    prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def summary(conf: DataFrame, group_cols: Sequence[str] = (), focus: Sequence[int] = (),
            weights: dict[str, float] = BLEND_WEIGHTS) -> DataFrame:
    """E1-E6, E8 per group: accuracy, micro / macro / weighted F1, mean recall
    of the focus classes (missing class -> recall 0; no focus -> weighted F1)
    and the blend score."""
    g = list(group_cols)
    pc = per_class(conf, g)
    focus = [int(f) for f in focus]
    if focus:
        fr = F.sum(F.when(F.col("cls").isin(*focus), F.col("recall")).otherwise(0.0)) / F.lit(float(len(focus)))
    else:
        fr = None
    agg = pc.groupBy(*g).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
        *([fr.alias("focus_recall")] if fr is not None else []),
    )
    if fr is None:
        agg = agg.withColumn("focus_recall", F.col("weighted_f1"))
    agg = agg.withColumn("micro_f1", F.col("accuracy"))
    blend = (F.lit(weights["micro"]) * F.col("micro_f1") + F.lit(weights["weighted"]) * F.col("weighted_f1")
             + F.lit(weights["focus_recall"]) * F.col("focus_recall"))
    return agg.withColumn("blend", blend).select(*g, "accuracy", "micro_f1", "macro_f1", "weighted_f1",
                                                 "focus_recall", "blend")


def class_report(conf: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per-class precision / recall / F1 / support plus 'accuracy',
    'macro avg' and 'weighted avg' rows (row name in ``row``)."""
    g = list(group_cols)
    pc = per_class(conf, g)
    cls_rows = pc.select(*g, F.col("cls").cast("string").alias("row"), "precision", "recall", "f1",
                         F.col("support").cast("bigint").alias("support"))
    tot = pc.groupBy(*g).agg(
        F.sum("support").alias("support"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    acc = tot.select(*g, F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("support")).alias("f1"),
                     F.col("support").cast("bigint").alias("support"))
    mac = tot.select(*g, F.lit("macro avg").alias("row"), F.col("mp").alias("precision"),
                     F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("support").cast("bigint").alias("support"))
    wei = tot.select(*g, F.lit("weighted avg").alias("row"), F.col("wp").alias("precision"),
                     F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("support").cast("bigint").alias("support"))
    return cls_rows.unionByName(acc).unionByName(mac).unionByName(wei)


def fold_summary(scores: DataFrame, score: str = "score", group_cols: Sequence[str] = ()) -> DataFrame:
    """Mean and population std of per-fold scores."""
    return scores.groupBy(*group_cols).agg(F.avg(score).alias("mean_score"),
                                           F.stddev_pop(score).alias("std_score"))
