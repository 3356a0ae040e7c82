"""Class statistics and one-way ANOVA.

All statistics are mergeable aggregates (count, mean, population variance)
grouped by small keys, so Spark combines them map-side before any shuffle and
a class holding a third of all rows costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabtext.functions.fdist import f_pvalue
from tabtext.operators.missing import exact_medians


def class_counts(df: DataFrame, label: str = "label", group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., label, n) over labelled rows."""
    return (df.filter(F.col(label).isNotNull()).groupBy(*group_cols, label)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def class_summary(counts: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per group the number of classes, the median of the non-zero
    class counts truncated to an integer, and max/min imbalance ratio. The
    input is the small class-count table."""
    nz = counts.filter(F.col("n") > 0)
    return nz.groupBy(*group_cols).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_classes"),
        F.floor(F.median("n")).cast("bigint").alias("median_count"),
        (F.max("n") / F.min("n")).alias("imbalance_ratio"),
    )


def anova(long: DataFrame, feature: str = "feature", value: str = "value", label: str = "label",
          fill_median: bool = True, medians: DataFrame | None = None) -> DataFrame:
    """One-way ANOVA per feature over labelled rows.

    ``long`` has one row per (case, feature) with a possibly-null value;
    nulls are filled with the feature's median over labelled rows first
    (N2). Output: feature, n, k, f_stat, p_value. F is +inf when the
    within-class sum of squares is 0 and the between-class one is not, NaN
    when both are 0 (constant column) or the feature has no values.
    """
    x = long.filter(F.col(label).isNotNull()).select(feature, label, F.col(value).cast("double").alias("_x"))
    # per (feature, class): moments of the observed values + count of filled ones; the fill joins these few rows
    g = x.groupBy(feature, label).agg(
        F.count("_x").alias("n1"), F.avg("_x").alias("m1"), F.var_pop("_x").alias("v1"),
        (F.count(F.lit(1)) - F.count("_x")).alias("n0"))
    if fill_median:
        med = medians if medians is not None else exact_medians(x, [feature], "_x")
        g = g.join(med.select(feature, F.col("median").alias("fill")), feature, "left")
    else:
        g = g.withColumn("fill", F.lit(None).cast("double"))
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    has_fill = F.col("fill").isNotNull() & (F.col("n0") > 0)
    nk = F.when(has_fill, n1 + n0).otherwise(n1)
    mean = F.when(has_fill & (F.col("n1") > 0), (n1 * F.col("m1") + n0 * F.col("fill")) / (n1 + n0)) \
        .when(has_fill, F.col("fill")).otherwise(F.col("m1"))
    m2 = F.when(F.col("n1") > 0, F.col("v1") * n1).otherwise(F.lit(0.0))
    m2 = F.when(has_fill & (F.col("n1") > 0),
                m2 + n1 * n0 / (n1 + n0) * (F.col("m1") - F.col("fill")) ** 2).otherwise(m2)
    g = g.select(feature, label, nk.alias("nk"), mean.alias("mk"), m2.alias("m2k")).filter("nk > 0")
    tot = g.groupBy(feature).agg(F.sum("nk").alias("n"), F.count(F.lit(1)).alias("k"),
                                 (F.sum(F.col("nk") * F.col("mk")) / F.sum("nk")).alias("grand"))
    s = g.join(tot, feature).groupBy(feature, "n", "k").agg(
        F.sum(F.col("nk") * (F.col("mk") - F.col("grand")) ** 2).alias("ssb"),
        F.sum("m2k").alias("ssw"))
    d1 = F.col("k") - 1
    d2 = F.col("n") - F.col("k")
    msb = F.col("ssb") / d1.cast("double")
    msw = F.col("ssw") / d2.cast("double")
    f = (F.when((d1 <= 0) | (d2 <= 0), F.lit(float("nan")))
         .when(F.col("ssw") == 0, F.when(F.col("ssb") > 0, F.lit(float("inf"))).otherwise(F.lit(float("nan"))))
         .otherwise(msb / msw))
    out = s.select(feature, F.col("n").cast("bigint").alias("n"), F.col("k").cast("bigint").alias("k"),
                   f.alias("f_stat"))
    # the Arrow round trip of the UDF turns NaN into null: keep NaN explicit
    p = f_pvalue(F.col("f_stat"), (F.col("k") - 1).cast("double"), (F.col("n") - F.col("k")).cast("double"))
    return out.withColumn("p_value", F.when(F.isnan("f_stat"), F.lit(float("nan"))).otherwise(p))


def anova_keep(stats: DataFrame, features: Sequence[str], p_threshold: float = 0.05,
               n_labels: int | None = None) -> list[str]:
    """features with finite p <= threshold; fewer than 2 labels -> all."""
    if n_labels is not None and n_labels < 2:
        return list(features)
    keep = {r["feature"] for r in stats.filter(
        ~F.isnan("p_value") & F.col("p_value").isNotNull() & (F.col("p_value") <= p_threshold)).select("feature").collect()}
    return [c for c in features if c in keep]
