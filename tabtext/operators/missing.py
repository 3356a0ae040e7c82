"""Null rates, exact medians, imputation, sparse-column drop and missing
indicators (G1, G2, N1-N4).

Exact medians are computed by distributed selection: per key, equal-width
bucket counts over the current value range narrow down the two middle ranks
until the candidate values per key fit a bounded ``cap``; only then are the
remaining candidates gathered (at most ``cap`` per key) and picked. No task
ever holds all values of a column, whatever the data size.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def to_long(df: DataFrame, cols: Sequence[str], id_cols: Sequence[str] = (),
            name: str = "column", value: str = "value") -> DataFrame:
    """Wide -> long (id..., column, value) with a narrow explode (no shuffle)."""
    arr = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
    return df.select(*id_cols, F.inline(arr))


def null_rates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, null_rate) for all columns in ONE aggregation pass."""
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(f"_r{i}") for i, c in enumerate(cols)])
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_r{i}").cast("double").alias("null_rate"))
                    for i, c in enumerate(cols)])
    return wide.select(F.inline(arr))


def null_rate_map(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    return {r["column"]: r["null_rate"] for r in null_rates(df, cols).collect()}


def exact_medians(long: DataFrame, keys: Sequence[str], value: str, cap: int = 100_000,
                  buckets: int = 1024) -> DataFrame:
    """(keys..., median): exact interpolated median per key, nulls/NaN skipped.

    Infinite values count by their ranks; only the finite ones are searched.
    Every round narrows: the two values that bound a range never share a
    bucket on the even, linear scale (computed on halves, so no difference
    overflows); the odd rounds use a logarithmic scale, which takes ranges
    over many magnitudes in few steps."""
    keys = list(keys)
    spark = long.sparkSession
    x = long.select(*keys, F.col(value).cast("double").alias("_v"))
    x = x.withColumn("_v", F.when(~F.isnan("_v"), F.col("_v")))  # NaN counts as missing
    v = x.filter(F.col("_v").isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # every key, also those without any value (their median is null)
        fin = F.when(F.abs("_v") != float("inf"), F.col("_v"))
        st = x.groupBy(*keys).agg(F.count("_v").alias("n"), F.min(fin).alias("lo"), F.max(fin).alias("hi"),
                                  F.count(fin).alias("fin"), F.count_if(F.col("_v") == float("-inf")).alias("neg"))
        state, done = {}, {}
        for r in st.collect():  # one row per key (number of features)
            k = tuple(r[c] for c in keys)
            n = int(r["n"])
            neg, m = int(r["neg"]), int(r["fin"])
            k1, k2 = (n - 1) // 2 - neg, n // 2 - neg  # ranks among the finite values
            state[k] = dict(n=n, lo=r["lo"], hi=r["hi"], below=0, cnt=m, k1=k1, k2=k2)
            if n == 0:
                done[k] = None
            elif k1 < 0 and k2 >= m:
                done[k] = float("nan")
            elif k1 < 0 or k2 >= m:
                done[k] = float("-inf" if k1 < 0 else "inf")
            elif r["lo"] == r["hi"]:
                done[k] = float(r["lo"])
        rounds = 0
        while True:
            pending = {k: s for k, s in state.items() if k not in done}
            if not pending:
                break
            small = {k: s for k, s in pending.items() if s["cnt"] <= cap}
            big = {k: s for k, s in pending.items() if k not in small}
            if small:
                done.update(_pick_small(spark, v, keys, small))
            if not big:
                break
            done.update(_narrow(spark, v, keys, big, buckets, log=rounds % 2 == 1))
            rounds += 1
        schema = ", ".join(f"`{c}` {t}" for c, t in long.select(*keys).dtypes) + ", median double"
        rows = [(*k, done.get(k)) for k in state]
        return spark.createDataFrame(rows, schema)
    finally:
        v.unpersist()


def _state_df(spark, keys, sub: Mapping[tuple, dict], v: DataFrame):
    cols = list(keys) + ["lo", "hi", "below", "k1", "k2"]
    rows = [(*k, float(s["lo"]), float(s["hi"]), int(s["below"]), int(s["k1"]), int(s["k2"])) for k, s in sub.items()]
    types = dict(v.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in keys) + ", lo double, hi double, below bigint, k1 bigint, k2 bigint"
    # bounded: one row per pending key
    return F.broadcast(spark.createDataFrame(rows, schema)), cols


def _pick_small(spark, v, keys, sub):
    t, _ = _state_df(spark, keys, sub, v)
    cand = v.join(t, keys).filter((F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
    agg = cand.groupBy(*keys, "below", "k1", "k2").agg(F.sort_array(F.collect_list("_v")).alias("vals"))
    pick = agg.select(*keys, (F.element_at("vals", (F.col("k1") - F.col("below") + 1).cast("int")) / 2.0
                               + F.element_at("vals", (F.col("k2") - F.col("below") + 1).cast("int")) / 2.0)
                      .alias("median"))
    return {tuple(r[c] for c in keys): r["median"] for r in pick.collect()}


def _log(x):
    return F.signum(x) * F.log1p(F.abs(x))


def _narrow(spark, v, keys, sub, buckets, log=False):
    t, _ = _state_df(spark, keys, sub, v)
    x = v.join(t, keys).filter((F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
    at = (lambda c: _log(F.col(c))) if log else (lambda c: F.col(c) / 2.0)
    width = at("hi") - at("lo")
    b = F.when(width > 0, F.least(F.floor((at("_v") - at("lo")) / width * buckets), F.lit(buckets - 1))) \
        .otherwise(F.lit(0)).cast("int")
    h = x.withColumn("_b", b).groupBy(*keys, "below", "k1", "k2", "_b").agg(
        F.count(F.lit(1)).alias("c"), F.min("_v").alias("bmin"), F.max("_v").alias("bmax"))
    w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    h = h.withColumn("before", F.col("below") + F.coalesce(F.sum("c").over(w), F.lit(0)))
    hit = lambda k: (F.col(k) >= F.col("before")) & (F.col(k) < F.col("before") + F.col("c"))
    sel = h.filter(hit("k1") | hit("k2")).select(
        *keys, "_b", "c", "bmin", "bmax", "before", hit("k1").alias("h1"), hit("k2").alias("h2"))
    done = {}
    by_key: dict[tuple, list] = {}
    for r in sel.collect():  # at most two buckets per key
        by_key.setdefault(tuple(r[c] for c in keys), []).append(r)
    for k, rs in by_key.items():
        s = sub[k]
        if len(rs) == 1:
            r = rs[0]
            if r["bmin"] == r["bmax"]:
                done[k] = float(r["bmin"])
            else:
                s.update(lo=r["bmin"], hi=r["bmax"], below=int(r["before"]), cnt=int(r["c"]))
        else:
            r1 = next(r for r in rs if r["h1"])
            r2 = next(r for r in rs if r["h2"])
            done[k] = float(r1["bmax"]) / 2.0 + float(r2["bmin"]) / 2.0
    return done


def column_medians(df: DataFrame, cols: Sequence[str], **kw) -> DataFrame:
    """G1: (column, median) over the rows of ``df``."""
    return exact_medians(to_long(df, cols), ["column"], "value", **kw)


def median_map(df: DataFrame, cols: Sequence[str], **kw) -> dict[str, float | None]:
    if not cols:
        return {}
    return {r["column"]: r["median"] for r in column_medians(df, cols, **kw).collect()}


def fill_missing(df: DataFrame, medians: Mapping[str, float | None], string_cols: Iterable[str] = (),
                 report_col: str | None = "report", unknown: str = "Unknown") -> DataFrame:
    """Strings -> 'Unknown', report -> '', numerics -> the given (train)
    median; a null median leaves the column null. Keys and the label are
    simply not passed."""
    # whole-number columns become double: their median may be fractional
    exprs = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in medians.items() if m is not None}
    exprs.update({c: F.coalesce(F.col(c), F.lit(unknown)) for c in string_cols})
    if report_col and report_col in df.columns:
        exprs[report_col] = F.coalesce(F.col(report_col), F.lit(""))
    return df.withColumns(exprs) if exprs else df


def sparse_columns(rates: Mapping[str, float], threshold: float = 0.40) -> list[str]:
    """Columns whose (train) null rate exceeds ``threshold``."""
    return [c for c, r in rates.items() if r is not None and r > threshold]


def add_missing_indicators(df: DataFrame, cols: Iterable[str], suffix: str = "__is_missing") -> DataFrame:
    """``{c}__is_missing`` 0/1; call before filling. Absent columns count
    as missing (the reference adds them as null first)."""
    exprs = {}
    for c in cols:
        exprs[f"{c}{suffix}"] = (F.col(c).isNull().cast("int") if c in df.columns else F.lit(1))
    return df.withColumns(exprs)


def indicator_columns(rates: Mapping[str, float], threshold: float = 0.10) -> list[str]:
    return [c for c, r in rates.items() if r is not None and r > threshold]
