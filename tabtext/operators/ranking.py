"""Distributed ``row_number() over (partition by g order by o)``.

A window partitioned by a class label sends the whole class to one task; with
one class holding a third of all rows that task holds a third of the data.
Here rows are range-partitioned on (g, o) - a hot group spans many tasks -
sorted within partitions and numbered locally with
``monotonically_increasing_id``; a small table of (partition, group) counts
gives each partition's offset inside its group. The numbered rows are
checkpointed to the reliable checkpoint folder so ids are frozen (and
survive executor loss) before they are used twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabtext.session import cut_lineage

_MASK = (1 << 33) - 1


def row_number_within(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column | str],
                      out: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = 1-based position of the row inside its group in
    ``order`` (which must be a total order within the group for a
    deterministic result)."""
    group_cols = list(group_cols)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g) for g in group_cols] + order
    s = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    s = cut_lineage(s.withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright(F.col("_mid"), 33)
    pos = F.col("_mid").bitwiseAND(F.lit(_MASK))
    # one row per (partition, group) present: at most partitions + groups rows
    c = s.groupBy(pid.alias("_pid"), *group_cols).agg(F.min(pos).alias("_first"),
                                                      F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("_off", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    j = s.withColumn("_pid", pid).join(c.drop("_c"), ["_pid", *group_cols])
    return j.withColumn(out, (pos - F.col("_first") + F.col("_off") + 1).cast("bigint")) \
        .drop("_pid", "_first", "_off", "_mid")
