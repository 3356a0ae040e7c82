"""Folds, upsampling, class weights, hash splits, seeded orderings
(B1-B4, O7).

Every random choice is md5 of (seed, key) so results do not depend on
partitioning, task order or retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabtext.functions.hashing import hash_split, md5_u32
from tabtext.operators.ranking import row_number_within
from tabtext.operators.stats import class_counts

DRAW_CHUNK = 1_000_000


def stratified_folds(df: DataFrame, k: int = 5, seed: int = 42, label: str = "label",
                     key: str = "case_id", out: str = "fold") -> DataFrame:
    """B1: ``fold`` in [0, k): rows of each class in md5(seed|key) order are
    dealt round-robin, so per-class fold sizes differ by at most one."""
    h = md5_u32(F.lit(str(seed)), F.col(key))
    x = df.withColumn("_h", h)
    r = row_number_within(x, [label], ["_h", key], out="_rn")
    return r.withColumn(out, ((F.col("_rn") - 1) % k).cast("int")).drop("_h", "_rn")


def upsample_focus(df: DataFrame, focus: Sequence[str], seed: int = 42, label: str = "label",
                   key: str | Sequence[str] = "case_id", copy_col: str = "copy") -> DataFrame:
    """B2: rows of each focus class are topped up, with replacement, to
    ``max(3 n_k, median class count)``; originals are kept (``copy`` 0),
    draw j of class c picks rank ``md5(seed|c|j) mod n_c + 1`` in key order.
    Empty or absent focus classes are skipped. Draws are generated in
    bounded chunks so no task expands a large class alone."""
    base = df.withColumn(copy_col, F.lit(0).cast("bigint"))
    if not focus:
        return base
    # class table: one row per class (bounded by the number of classes)
    counts = {r[label]: int(r["n"]) for r in class_counts(df, label).collect()}
    nz = sorted(n for n in counts.values() if n > 0)
    if not nz:
        return base
    mid = len(nz) // 2
    med = int(nz[mid] if len(nz) % 2 else (nz[mid - 1] + nz[mid]) / 2)
    rows = [(c, counts[c], max(3 * counts[c], med) - counts[c]) for c in focus if counts.get(c, 0) > 0]
    rows = [r for r in rows if r[2] > 0]
    if not rows:
        return base
    ltype = dict(df.dtypes)[label]
    need = df.sparkSession.createDataFrame(rows, f"`{label}` {ltype}, n bigint, extra bigint")
    chunks = need.select(label, "n", "extra",
                         F.explode(F.sequence(F.lit(0).cast("bigint"),
                                              F.ceil(F.col("extra") / DRAW_CHUNK).cast("bigint") - 1)).alias("_chunk"))
    draws = chunks.repartition(label, "_chunk").select(
        label, "n", F.explode(F.sequence(F.col("_chunk") * DRAW_CHUNK + 1,
                                         F.least((F.col("_chunk") + 1) * DRAW_CHUNK, F.col("extra")))).alias(copy_col))
    draws = draws.select(label, copy_col,
                         (F.pmod(md5_u32(F.lit(str(seed)), F.col(label), F.col(copy_col)), F.col("n")) + 1).alias("_rn"))
    order = [key] if isinstance(key, str) else list(key)
    ranked = row_number_within(df.filter(F.col(label).isin(*focus)), [label], order, out="_rn")
    extra_rows = ranked.join(draws, [label, "_rn"]).drop("_rn")
    return base.unionByName(extra_rows.select(*base.columns))


def upsample_wide(df: DataFrame, focus: Sequence[str], seed: int = 42, label: str = "label",
                  key: str = "case_id", copy_col: str = "copy") -> DataFrame:
    """B2 for rows that hold feature vectors: the rows of ``upsample_focus``, ranked and drawn on (key, label)
    alone. Draws are counted per row first, so a row drawn often costs one joined row and is repeated in place.
    ``df`` must read a materialised table (checkpoint): equal keys are told apart by the position in it."""
    x = df.withColumn("_row", F.monotonically_increasing_id())
    drawn = upsample_focus(x.select(key, "_row", label), focus, seed, label, [key, "_row"], "_j")
    extra = drawn.filter("_j > 0").groupBy("_row").agg(F.count(F.lit(1)).alias("_extra"))
    x = x.join(extra, "_row", "left")
    last = F.coalesce("_extra", F.lit(0).cast("bigint"))
    return x.withColumn(copy_col, F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("_row", "_extra")


def balanced_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """``N / (K n_k)`` per row; the class table has K rows."""
    counts = {r[label]: int(r["n"]) for r in class_counts(df, label).collect()}  # K rows
    total, k = sum(counts.values()), len(counts)
    rows = [(c, total / (k * n)) for c, n in counts.items()]
    ltype = dict(df.dtypes)[label]
    w = df.sparkSession.createDataFrame(rows, f"`{label}` {ltype}, `{out}` double")
    return df.join(F.broadcast(w), label, "left")


def assign_split(df: DataFrame, key: str = "case_id", train: int = 70, val: int = 10,
                 out: str = "split") -> DataFrame:
    """md5 bucket split 70 / 10 / 20."""
    return df.withColumn(out, hash_split(F.col(key), train, val))


def seeded_order(df: DataFrame, seed: int = 42, key: str = "case_id", out: str = "position") -> DataFrame:
    """A seeded permutation made observable as a 1-based position."""
    x = df.withColumn("_h", md5_u32(F.lit(str(seed)), F.col(key)))
    return row_number_within(x, [], ["_h", key], out=out).drop("_h")
