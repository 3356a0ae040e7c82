"""Equi-joins on the case key.

Data-dependent sides are left to Spark's planner: it broadcasts a side whose
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
re-plans with measured sizes, otherwise a sort-merge join is used. Explicit
``broadcast`` is reserved for sides with a proven bound.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_clinical(clinical: DataFrame | None, cases: DataFrame, key: str = "case_id") -> DataFrame:
    """Clinical LEFT JOIN case rows; without clinical the cases pass."""
    if clinical is None:
        return cases
    return clinical.join(cases, key, "left")


def merge_modalities(frames: Sequence[DataFrame], how: str = "full", key: str = "case_id",
                     strategy: str = "join") -> DataFrame:
    """Merge per-modality wide frames on ``key``.

    * ``join``  - chained joins (``how``), SQL fan-out on duplicate keys.
    * ``union`` - one shuffle for all frames: the union of the frames, one list
      of rows a frame and key, and inside each key the product of the lists (an
      absent frame gives nulls). Equals the chained full outer join, duplicate
      keys included. Keys are not null (P6).
    """
    if strategy == "union":
        if how != "full":
            raise ValueError("union strategy implements the full outer merge")
        names = [f"_f{i}" for i in range(len(frames))]
        wide = [f.select(key, F.struct(*[c for c in f.columns if c != key]).alias(n)) for n, f in zip(names, frames)]
        u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), wide)
        x = u.groupBy(key).agg(*[F.collect_list(n).alias(n) for n in names])
        for n in names:
            x = x.withColumn(n, F.explode_outer(n))
        return x.select(key, *[F.col(n)[c].alias(c) for n, f in zip(names, frames) for c in f.columns if c != key])
    return reduce(lambda a, b: a.join(b, key, how), frames)


def lookup_vector(base: DataFrame, vectors: DataFrame, dim: int, key: str = "case_id",
                  vec_key: str = "vec_id", vec: str = "vec", out: str = "vec") -> DataFrame:
    """Dense vector per row by key, zeros(dim) when absent."""
    v = vectors.select(F.col(vec_key).alias("_vk"), F.col(vec).alias("_vv"))
    j = base.join(v, base[key] == v["_vk"], "left")
    zero = F.array_repeat(F.lit(0.0), dim)
    return j.withColumn(out, F.coalesce(F.col("_vv"), zero)).drop("_vk", "_vv")


def concat_vectors(base: DataFrame, blocks: Sequence[tuple[str, DataFrame]], dim: int,
                   key: str = "case_id", out: str = "vec") -> DataFrame:
    """Look up one vector per block (zeros when absent) and concatenate in
    block order. Consecutive joins on the same key reuse the partitioning."""
    names = []
    for name, vdf in blocks:
        base = lookup_vector(base, vdf, dim, key, "case_id", "vec", f"_v_{name}")
        names.append(f"_v_{name}")
    return base.withColumn(out, F.concat(*[F.col(n) for n in names])).drop(*names)
