"""One-hot, label encoding, scaling, vector assembly and slicing
(V1, V6-V9, P13, P15, J5)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class OneHotModel:
    """Levels per categorical column (alphabetical) and the output layout:
    numeric columns first, then each categorical column's dummies."""

    numeric: list[str]
    categorical: list[str]
    levels: dict[str, list[str]]

    @property
    def feature_names(self) -> list[str]:
        out = list(self.numeric)
        for c in self.categorical:
            out += [f"{c}_{v}" for v in self.levels[c]]
        return out

    def offsets(self) -> dict[str, int]:
        off, o = {}, len(self.numeric)
        for c in self.categorical:
            off[c] = o
            o += len(self.levels[c])
        return off

    def transform(self, df: DataFrame, out: str = "tab") -> DataFrame:
        """Adds ``out``: vector [numerics | dummies]; null or unseen level ->
        all-zero block."""
        idx_cols, vec_cols = [], []
        x = df
        for c in self.categorical:
            m = StringIndexerModel.from_labels(self.levels[c], inputCol=c, outputCol=f"__{c}_idx",
                                               handleInvalid="keep")
            x = m.transform(x)
            idx_cols.append(f"__{c}_idx")
            vec_cols.append(f"__{c}_oh")
        if self.categorical:
            # the indexer's "unknown" bucket (nulls, unseen levels) is its last
            # category; drop-last removes it, so those rows get all zeros
            enc = OneHotEncoder(inputCols=idx_cols, outputCols=vec_cols, dropLast=True, handleInvalid="error")
            x = enc.fit(x).transform(x)
        x = x.withColumns({c: F.col(c).cast("double") for c in self.numeric})
        va = VectorAssembler(inputCols=[*self.numeric, *vec_cols], outputCol=out, handleInvalid="keep")
        return va.transform(x).drop(*idx_cols, *vec_cols)


def fit_one_hot(df: DataFrame, exclude: Sequence[str] = ()) -> OneHotModel:
    """V1: string columns become dummies with levels from ALL rows of ``df``
    (the reference encodes train, val and test together); other columns pass
    as numbers. Levels: one distinct aggregation over all categorical
    columns (long form, map-side combine) - bounded by cardinality."""
    ex = set(exclude)
    cols = [(c, t) for c, t in df.dtypes if c not in ex]
    cat = [c for c, t in cols if t == "string"]
    num = [c for c, t in cols if t != "string"]
    levels: dict[str, list[str]] = {c: [] for c in cat}
    if cat:
        arr = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in cat])
        lv = df.select(F.inline(arr)).filter(F.col("v").isNotNull()).distinct()
        for r in lv.collect():
            levels[r["c"]].append(r["v"])
        levels = {c: sorted(v) for c, v in levels.items()}
    return OneHotModel(numeric=num, categorical=cat, levels=levels)


def fit_labels(df: DataFrame, label: str = "label") -> list[str]:
    """V9: sorted distinct labels (K values)."""
    return sorted(r[0] for r in df.select(label).filter(F.col(label).isNotNull()).distinct().collect())


def encode_labels(df: DataFrame, labels: Sequence[str], label: str = "label", out: str = "y") -> DataFrame:
    """V9: label -> code in sorted order (unknown -> null)."""
    m = F.create_map(*[x for i, v in enumerate(labels) for x in (F.lit(v), F.lit(i))])
    return df.withColumn(out, m[F.col(label)].cast("int"))


def decode_labels(df: DataFrame, labels: Sequence[str], code: str = "pred", out: str = "pred_label") -> DataFrame:
    """V9 inverse: code -> label."""
    arr = F.array(*[F.lit(v) for v in labels])
    return df.withColumn(out, F.get(arr, F.col(code).cast("int")))


def focus_ids(labels: Sequence[str], focus: Sequence[str]) -> list[int]:
    """Codes of the focus names that exist."""
    pos = {v: i for i, v in enumerate(labels)}
    return [pos[f] for f in focus if f in pos]


def fit_std_pop(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Population std per column over the fit rows, one aggregation."""
    r = df.agg(*[F.stddev_pop(c).alias(f"_s{i}") for i, c in enumerate(cols)]).first()
    return {c: r[f"_s{i}"] for i, c in enumerate(cols)}


def scale_no_center(df: DataFrame, stds: dict[str, float | None]) -> DataFrame:
    """V8: divide by the fitted population std; zero / undefined std leaves
    the column unchanged (Spark ML's StandardScaler uses the sample std)."""
    return df.withColumns({c: (F.col(c) / F.lit(s)) if s else F.col(c) for c, s in stds.items()})


def scale_vector_no_center(df: DataFrame, vec: str, fit_filter=None, out: str | None = None) -> DataFrame:
    """V8 for a vector column: per-dimension population std from
    ``Summarizer`` (sample variance rescaled by (n-1)/n), zeros -> 1."""
    from pyspark.ml.feature import ElementwiseProduct
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.stat import Summarizer

    fit = df.filter(fit_filter) if fit_filter is not None else df
    s = fit.select(Summarizer.metrics("variance", "count").summary(F.col(vec)).alias("s")).first()["s"]
    n = float(s["count"])
    var = s["variance"].toArray()
    scale = [1.0 / ((v * (n - 1) / n) ** 0.5) if n > 1 and v > 0 else 1.0 for v in var]
    return ElementwiseProduct(scalingVec=Vectors.dense(scale), inputCol=vec, outputCol=out or f"{vec}_scaled").transform(df)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Horizontal concatenation of vector/numeric columns."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def slice_vector(df: DataFrame, vec: str, indices: Sequence[int], out: str) -> DataFrame:
    """Column subset of a vector by index list."""
    return VectorSlicer(inputCol=vec, outputCol=out, indices=[int(i) for i in indices]).transform(df)


def to_float_array(df: DataFrame, vec: str, out: str, dtype: str = "float32") -> DataFrame:
    """Vector -> array<float>."""
    return df.withColumn(out, vector_to_array(vec, dtype))
