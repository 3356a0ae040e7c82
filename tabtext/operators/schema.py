"""Schema operators: exact-name projection/drop, prefix rename, alignment to
the train schema, split filters and unions (P1-P13, U1-U3)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_exact(df: DataFrame, keep: Sequence[int]) -> DataFrame:
    """Columns by *position*: Spark resolves names case-insensitively, so
    ``sex`` and ``Sex`` cannot be told apart by name."""
    names = df.columns
    tmp = [f"_c{i}" for i in range(len(names))]
    return df.toDF(*tmp).select(*[F.col(tmp[i]).alias(names[i]) for i in keep])


def drop_exact(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns whose name equals one of ``names`` (case-sensitive);
    absent names are ignored."""
    drop = set(names)
    keep = [i for i, c in enumerate(df.columns) if c not in drop]
    if len(keep) == len(df.columns):
        return df
    return select_exact(df, keep)


def prefix_project(df: DataFrame, key: str = "case_id", prefix: str = "rad_") -> DataFrame:
    """Key plus the columns whose name starts with ``prefix``."""
    return df.select(key, *[c for c in df.columns if c.startswith(prefix)])


def feature_columns(columns: Iterable[str], marker: str = "__rad_", prefix: str = "rad_") -> list[str]:
    """Names containing ``marker`` or starting with ``prefix``."""
    return [c for c in columns if marker in c or c.startswith(prefix)]


def prefix_columns(df: DataFrame, cols: Iterable[str], prefix: str) -> DataFrame:
    """Rename ``cols`` to ``prefix + name``."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in cols})


def try_numeric(col: str) -> F.Column:
    """P5: text -> double, bad text -> null (``cast`` raises under ANSI)."""
    return F.expr(f"try_cast(`{col}` AS DOUBLE)")


def exact_id(col: str) -> F.Column:
    """Whole-number text (``12``, ``12.0``, ``1e3``) -> bigint, exact over
    the whole range; anything else -> null."""
    return F.expr(
        f"coalesce(try_cast(`{col}` AS BIGINT), "
        f"try_cast(regexp_extract(`{col}`, '^\\\\s*([+-]?[0-9]+)[.]0*\\\\s*$', 1) AS BIGINT), "
        f"CASE WHEN try_cast(`{col}` AS DOUBLE) = floor(try_cast(`{col}` AS DOUBLE)) "
        f"AND abs(try_cast(`{col}` AS DOUBLE)) <= 9007199254740992D "
        f"THEN try_cast(try_cast(`{col}` AS DOUBLE) AS BIGINT) END)")


def truncated_id(col: str) -> F.Column:
    """Numeric text -> bigint, fractions cut off; whole numbers stay exact."""
    d = F.expr(f"try_cast(`{col}` AS DOUBLE)")
    return F.coalesce(exact_id(col), F.when(F.abs(d) < F.lit(float(1 << 53)), d).try_cast("bigint"))


def align_union(frames: dict[str, DataFrame], reference: str = "train",
                split_col: str = "split") -> DataFrame:
    """P10 + U2: stack per-split frames under the reference split's schema:
    columns missing elsewhere become null, columns not in the reference are
    dropped. One DataFrame with a ``split`` column."""
    ref_cols = [c for c in frames[reference].columns if c != split_col]
    out = None
    for name, f in frames.items():
        part = f.drop(split_col) if split_col in f.columns else f
        part = part.select(*[c for c in part.columns if c in set(ref_cols)]).withColumn(split_col, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.select(*ref_cols, split_col)


def union_splits(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def split_filter(df: DataFrame, *splits: str, split_col: str = "split") -> DataFrame:
    """Rows of the given splits (never positional slicing)."""
    return df.filter(F.col(split_col).isin(*splits))


def label_mask(df: DataFrame, label: str = "label") -> DataFrame:
    """Labelled rows only."""
    return df.filter(F.col(label).isNotNull())
