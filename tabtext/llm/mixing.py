"""Mixing sources to target weights by Pfair scheduling.

Documents of a source form blocks of ``block`` documents in a seeded order. Integer weights a_s with sum
L give the i-th block of source s (from 0) the release time floor(i*L/a_s) and the deadline
ceil((i+1)*L/a_s); at each slot the released block with the earliest deadline runs (ties: source name),
so after every slot each source is less than one block away from its target share, as long as all
sources have blocks. Since the pattern repeats after L slots, the schedule of one period (L entries, at
most ``MAX_PERIOD``, checked) is made once and every block finds its slot by one small lookup:
slot = (i div a_s)*L + slot of block (i mod a_s). No document passes through the driver.

Each document is placed exactly once. When a source has run dry its slots stay empty and the others go
on in the ratio of their weights. Null sources form a source of their own (named by the empty string when
ordering ties). Identical rows are placed one by one. An empty table gives an empty mix.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabtext.llm.common import fresh_name
from tabtext.operators.ranking import row_number_within
from tabtext.session import written

BLOCK = 16
SCALE = 1000
MAX_PERIOD = 20_000


def quantise(shares: dict, scale: int = SCALE) -> dict:
    """Integer weights near ``scale`` times the share of the sum, each at least 1."""
    total = math.fsum(shares.values())
    return {k: max(1, math.floor(Fraction(v) / Fraction(total) * scale + Fraction(1, 2))) for k, v in shares.items()}


def period(weights: dict) -> list:
    """Source of each slot of one period: earliest deadline first among released blocks."""
    length = sum(weights.values())
    if length > MAX_PERIOD:
        raise ValueError(f"period of {length} slots; at most {MAX_PERIOD}")
    order = sorted(weights, key=lambda k: "" if k is None else k)
    done = dict.fromkeys(order, 0)
    out = []
    for t in range(length):
        open_now = [(-(-(done[s] + 1) * length // weights[s]), n, s) for n, s in enumerate(order)
                    if done[s] < weights[s] and done[s] * length // weights[s] <= t]
        deadline, _, s = min(open_now)
        assert deadline > t, "a block misses its deadline"
        out.append(s)
        done[s] += 1
    return out


def source_counts(docs: DataFrame, source: str = "source") -> dict:
    """Rows of each source (one driver row per source; more than MAX_PERIOD sources are refused)."""
    rows = docs.groupBy(F.col(source).cast("string").alias("s")).count().limit(MAX_PERIOD + 1).collect()
    if len(rows) > MAX_PERIOD:
        raise ValueError(f"more than {MAX_PERIOD} sources")
    return {r.s: r["count"] for r in rows}


def default_weights(docs: DataFrame, source: str = "source") -> dict:
    """Targets between proportional and uniform: the square root of a source's rows."""
    return quantise({k: math.sqrt(v) for k, v in source_counts(docs, source).items()})


def schedule(docs: DataFrame, weights: dict | None = None, doc_id: str = "doc_id", source: str = "source",
             block: int = BLOCK, seed: str = "mix", row: str | None = None) -> DataFrame:
    """Row per row of ``docs``: doc_id, source, block (from 0), slot, position (slot * block + place in
    the block). Order inside a source: md5 of seed and doc_id, then doc_id, then the column ``row``, which is kept."""
    spark = docs.sparkSession
    if weights is None:
        weights = default_weights(docs, source)
    elif missing := set(source_counts(docs, source)) - set(weights):
        raise ValueError(f"sources without a weight: {sorted(map(str, missing))[:10]}")
    kept = [] if row is None else [F.col(row).alias("_row")]
    d = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("source"), *kept)
    kept = [] if row is None else ["_row"]
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    ranked = row_number_within(d.withColumn("_s", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
                               .withColumn("_k", key), ["_s"], ["_k", "doc_id", *kept])
    if not weights:
        return ranked.select(*kept, "doc_id", "source", F.lit(0).cast("bigint").alias("block"),
                             F.lit(0).cast("bigint").alias("slot"), F.lit(0).cast("bigint").alias("position")).limit(0)
    length, seen, rows = sum(weights.values()), dict.fromkeys(weights, 0), []
    for t, s in enumerate(period(weights)):
        rows.append(("" if s is None else "=" + s, seen[s], t, weights[s], length))
        seen[s] += 1
    slots = spark.createDataFrame(rows, "_s string, _i bigint, _t bigint, _a bigint, _l bigint")
    shares = slots.groupBy("_s").agg(F.first("_a").alias("_a"), F.first("_l").alias("_l"))
    i = F.floor((F.col("rn") - 1) / F.lit(block)).cast("bigint")
    return ranked.withColumn("block", i).join(F.broadcast(shares), "_s") \
        .withColumn("_i", F.col("block") % F.col("_a")) \
        .join(F.broadcast(slots.drop("_a", "_l")), ["_s", "_i"]) \
        .withColumn("slot", F.expr("block div _a") * F.col("_l") + F.col("_t")) \
        .select(*kept, "doc_id", "source", "block", "slot",
                (F.col("slot") * block + (F.col("rn") - 1) % block).alias("position"))


def mix(docs: DataFrame, weights: dict | None = None, doc_id: str = "doc_id", source: str = "source",
        block: int = BLOCK) -> DataFrame:
    """All rows and columns of ``docs``, range-partitioned and sorted by their place in the mix, so that
    files written from it hold the mix in order. Every row has a place of its own, also where ids are null or repeated: rows
    of a table are told apart by file and row number, those of other frames are numbered and written once, so a task that
    runs again sees the same."""
    r, p = fresh_name(docs, "_mix_r"), fresh_name(docs, "_mix_p")
    try:
        t = docs.select("*", F.struct(F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r")).alias(r))
    except AnalysisException:
        t = written(docs.withColumn(r, F.monotonically_increasing_id()))
    s = schedule(t, weights, doc_id, source, block, row=r).select(F.col("_row").alias(r), F.col("position").alias(p))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return t.join(s, r).select(*docs.columns, p).repartitionByRange(n, p).sortWithinPartitions(p).drop(p)
