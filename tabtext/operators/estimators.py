"""Estimators whose fitted tables can be saved and loaded.

Each estimator wraps a fit of this package as a ``pyspark.ml`` Estimator, so it takes its place in a Pipeline; its model
keeps what was learned as a table (vocabulary, levels, medians, deviations) and writes it as Parquet next to the parameters.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, \
    MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from tabtext.operators import encode as EN
from tabtext.operators import missing as M
from tabtext.operators import tfidf as TF


class _Columns(Params):
    """The parameters that the estimators share."""

    inputCols = Param(Params._dummy(), "inputCols", "columns to fit on", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "column to add", TypeConverters.toString)

    def _cols(self) -> list[str]:
        return self.getOrDefault(self.inputCols)

    def _out(self) -> str:
        return self.getOrDefault(self.outputCol)


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        rows, schema, facts = self.instance.learned()
        DefaultParamsWriter.saveMetadata(self.instance, path, spark, extraMetadata={"facts": facts})
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/learned")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        spark = SparkSession.getActiveSession()
        meta, out = DefaultParamsReader.loadMetadata(path, spark), self.cls()
        out._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(out, meta)
        out.relearn(spark.read.parquet(f"{path}/learned").collect(), meta["facts"])  # what the fit had on the driver as well
        return out


class _TableModel(Model, _Columns, MLWritable, MLReadable):
    """``learned``: rows, schema and a few facts; ``relearn`` takes them back."""

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)


class _TableEstimator(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    def _model(self, model):
        return self._copyValues(model)


class TfidfModel(_TableModel):
    """TF-IDF vectors of the text in the first input column."""

    def learned(self):
        m = self.fitted
        return [(i, t, d, c, w) for i, (t, d, c, w) in enumerate(zip(m.terms, m.df, m.cf, m.idf))], \
            "idx int, term string, df bigint, cf bigint, idf double", \
            {"n_docs": m.n_docs, "analyzer": m.analyzer, "ngram_range": list(m.ngram_range), "name": m.name}

    def relearn(self, rows, facts):
        rows = sorted(rows, key=lambda r: r["idx"])
        self.fitted = TF.TfidfModel([r["term"] for r in rows], [r["idf"] for r in rows], [r["df"] for r in rows], [r["cf"] for r in rows],
                                    facts["n_docs"], facts["analyzer"], tuple(facts["ngram_range"]), True, facts["name"])

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.fitted.transform(df, self._cols()[0], self._out())


class Tfidf(_TableEstimator):
    """Input columns: text, row id."""

    analyzer = Param(Params._dummy(), "analyzer", "word or char_wb", TypeConverters.toString)
    ngrams = Param(Params._dummy(), "ngrams", "smallest and largest n", TypeConverters.toListInt)
    minDf = Param(Params._dummy(), "minDf", "rows a term must be in", TypeConverters.toInt)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "terms to keep", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, analyzer="word", ngrams=(1, 2), minDf=2, maxFeatures=2500):
        super().__init__()
        self._set(**{k: list(v) if isinstance(v, tuple) else v for k, v in self._input_kwargs.items()})
        self._setDefault(analyzer="word", ngrams=[1, 2], minDf=2, maxFeatures=2500)

    def _fit(self, df: DataFrame) -> TfidfModel:
        text, row = self._cols()
        model, get = TfidfModel(), self.getOrDefault
        model.fitted = TF.fit_tfidf(df, text, row, get(self.analyzer), tuple(get(self.ngrams)), get(self.minDf), get(self.maxFeatures))
        return self._model(model)


class OneHotModel(_TableModel):
    """[numbers | dummies] of the input columns."""

    def learned(self):
        m = self.fitted
        return [(c, v) for c in m.categorical for v in m.levels[c]], "c string, v string", {"numeric": m.numeric, "categorical": m.categorical}

    def relearn(self, rows, facts):
        levels = {c: sorted(r["v"] for r in rows if r["c"] == c) for c in facts["categorical"]}
        self.fitted = EN.OneHotModel(facts["numeric"], facts["categorical"], levels)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.fitted.transform(df, self._out())


class OneHot(_TableEstimator):
    """``levelsFrom``: an SQL condition on the rows whose levels count (all rows if empty), e.g. split = 'train'."""

    levelsFrom = Param(Params._dummy(), "levelsFrom", "condition on the rows that give levels", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, levelsFrom=""):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(levelsFrom="")

    def _fit(self, df: DataFrame) -> OneHotModel:
        model, where = OneHotModel(), self.getOrDefault(self.levelsFrom)
        model.fitted = EN.fit_one_hot((df.where(where) if where else df).select(*self._cols()))
        return self._model(model)


class _ByColumn(_TableModel):
    """One number for each column."""

    def learned(self):
        return [(c, self.fitted[c]) for c in self.fitted], "c string, v double", {}

    def relearn(self, rows, facts):
        self.fitted = {r["c"]: r["v"] for r in rows}


class FillModel(_ByColumn):
    """Numbers get the fitted median, strings "Unknown"."""

    def _transform(self, df: DataFrame) -> DataFrame:
        kinds = dict(df.dtypes)
        return M.fill_missing(df, self.fitted, [c for c in self._cols() if kinds[c] == "string"], None)


class Fill(_TableEstimator):
    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> FillModel:
        model, kinds = FillModel(), dict(df.dtypes)
        model.fitted = M.median_map(df, [c for c in self._cols() if kinds[c] != "string"])
        return self._model(model)


class ScaleModel(_ByColumn):
    """Division by the fitted population deviation."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return EN.scale_no_center(df, self.fitted)


class Scale(_TableEstimator):
    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ScaleModel:
        model = ScaleModel()
        model.fitted = EN.fit_std_pop(df, self._cols())
        return self._model(model)
