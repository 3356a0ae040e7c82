"""Word / char_wb TF-IDF with library-default weighting.

Weighting: ``tf * (ln((1 + N) / (1 + df)) + 1)``, then L2 per document per
block; vocabulary = terms with ``df >= min_df``, the ``max_features`` largest
corpus frequencies (ties: term ascending), indexed in alphabetical order;
vocabulary and idf come from the fit rows only, unseen terms are dropped.

Plan shape:
* fit: term counts in the tasks (word 1- and 2-grams by token numbers; other terms in-row by sort + run-length) ->
  ``groupBy(term)`` with map-side partial aggregation (a term present in every
  document becomes one row per task, so hot terms do not skew) -> top-k
  (TakeOrderedAndProject, bounded by ``max_features``) -> driver list.
* char n-grams: each row's distinct words are cut, not its whole text, and tasks
  add up (term, df, cf) before the exchange (``functions.ngrams``).
* transform: ``CountVectorizerModel.from_vocabulary`` (broadcast hash lookup)
  -> ``ElementwiseProduct(idf)`` -> ``Normalizer(2)``: a per-row map, no
  shuffle at any data size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorSlicer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabtext.functions.ngrams import char_gram_counts, char_wb_ngrams, count_char_grams, count_word_grams, with_term_counts, with_word_ngrams

BROADCAST_MAX_TERMS = 1_000_000
WORD_DEFAULTS = dict(analyzer="word", ngram_range=(1, 2), min_df=2, max_features=2500)
CHAR_DEFAULTS = dict(analyzer="char_wb", ngram_range=(3, 5), min_df=2, max_features=1200)


def with_terms(df: DataFrame, text: str, out: str, analyzer: str = "word",
               ngram_range: tuple[int, int] = (1, 2), lower: bool = True) -> DataFrame:
    """Adds ``out`` = array of analyzer terms of ``text``."""
    lo, hi = ngram_range
    if analyzer == "word":
        return with_word_ngrams(df, text, out, lo, hi, lower)
    if analyzer == "char_wb":
        return df.withColumn(out, char_wb_ngrams(F.col(text), lo, hi, lower))
    raise ValueError(f"unknown analyzer {analyzer!r}")


def term_rows(df: DataFrame, id_col: str, text: str, analyzer: str = "word",
              ngram_range: tuple[int, int] = (1, 2), keep: list[str] | None = None,
              terms_col: str | None = None) -> DataFrame:
    """Long form (id, *keep, term, n): distinct terms per row with counts.

    Counting happens inside the row; the explode is narrow. ``terms_col``
    names an already computed term array (then ``text`` is not read).
    """
    keep = keep or []
    if terms_col:
        x = df.select(id_col, F.col(terms_col).alias("_terms"), *keep)
    else:
        x = with_terms(df.select(id_col, text, *keep), text, "_terms", analyzer, ngram_range)
    x = with_term_counts(x, "_terms", "_tc")
    # explode_outer + null filter: a plain explode makes the optimizer infer
    # size(_tc) > 0 and push it below the projections, re-inlining the sort
    # into the lambdas (quadratic per row).
    return (x.select(id_col, *keep, F.explode_outer("_tc").alias("_e"))
            .filter(F.col("_e").isNotNull())
            .select(id_col, *keep, F.col("_e.term").alias("term"), F.col("_e.n").alias("n")))


def term_stats(rows: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """(group..., term, df, cf) from long term rows: document and corpus
    frequency per term (G11). Partial aggregation runs before the shuffle."""
    g = (group_cols or []) + ["term"]
    return rows.groupBy(*g).agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("cf"))


def text_term_stats(df: DataFrame, id_col: str, text: str, analyzer: str = "word", ngram_range: tuple[int, int] = (1, 2),
                    group_cols: list[str] | None = None, terms_col: str | None = None) -> DataFrame:
    """``term_stats`` of texts. Char n-grams are counted in the tasks, by the distinct words of each row, and word 1- and 2-grams by
    token numbers."""
    if analyzer == "char_wb" and not terms_col:
        return count_char_grams(df, text, *ngram_range, group=group_cols or [])
    if analyzer == "word" and not terms_col and tuple(ngram_range) in ((1, 1), (1, 2), (2, 2)):
        return count_word_grams(df, text, *ngram_range, group=group_cols or [])
    return term_stats(term_rows(df, id_col, text, analyzer, ngram_range, keep=group_cols, terms_col=terms_col), group_cols)


def with_counts(df: DataFrame, text: str, out: str, vocabulary: Sequence[str], analyzer: str, ngram_range: tuple[int, int],
                lower: bool = True, terms_col: str | None = None) -> DataFrame:
    """Adds ``out``: sparse vector of the occurrences of ``vocabulary`` (not empty) in each text."""
    if analyzer == "char_wb" and not terms_col:
        return df.withColumn(out, char_gram_counts(F.col(text), vocabulary, *ngram_range, lower))
    tmp = f"__{out}_terms"
    x = df.withColumn(tmp, F.col(terms_col)) if terms_col else with_terms(df, text, tmp, analyzer, ngram_range, lower)
    return CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol=tmp, outputCol=out).transform(x).drop(tmp)


def min_doc_count(min_df: int | float, n_docs: int) -> float:
    return float(min_df) if isinstance(min_df, int) else float(min_df) * n_docs


def select_vocabulary(stats: DataFrame, n_docs: int, min_df: int | float = 2,
                      max_features: int | None = None, max_df: int | float = 1.0) -> DataFrame:
    """Kept terms (term, df, cf, idx, idf) - bounded by ``max_features`` (O3)."""
    kept = stats.filter(F.col("df") >= F.lit(min_doc_count(min_df, n_docs)))
    if not (isinstance(max_df, float) and max_df >= 1.0):
        kept = kept.filter(F.col("df") <= F.lit(min_doc_count(max_df, n_docs)))
    if max_features is not None:
        kept = kept.orderBy(F.col("cf").desc(), F.col("term").asc()).limit(int(max_features))
    idf = F.log((F.lit(1.0) + F.lit(float(n_docs))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return kept.select("term", F.col("df").cast("bigint").alias("df"),
                       F.col("cf").cast("bigint").alias("cf"), idf.alias("idf"))


@dataclass
class TfidfModel:
    """Fitted vocabulary (alphabetical) with idf weights; ``transform`` adds a
    sparse L2-normalised vector column."""

    terms: list[str]
    idf: list[float]
    df: list[int]
    cf: list[int]
    n_docs: int
    analyzer: str = "word"
    ngram_range: tuple[int, int] = (1, 2)
    lower: bool = True
    name: str = "tfidf"
    extra: dict = field(default_factory=dict)

    @property
    def size(self) -> int:
        return len(self.terms)

    def vocabulary_df(self, spark) -> DataFrame:
        rows = [(t, i, d, c, w) for i, (t, d, c, w) in enumerate(zip(self.terms, self.df, self.cf, self.idf))]
        schema = "term string, idx int, df bigint, cf bigint, idf double"
        return spark.createDataFrame(rows, schema)

    def transform(self, df: DataFrame, text: str, out: str, terms_col: str | None = None) -> DataFrame:
        tmp_tf, tmp_w = f"__{out}_tf", f"__{out}_w"
        if not self.terms:  # empty vocabulary: zero-width block
            return df.withColumn(out, array_to_vector(F.array().cast("array<double>")))
        x = with_counts(df, text, tmp_tf, self.terms, self.analyzer, self.ngram_range, self.lower, terms_col)
        x = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol=tmp_tf, outputCol=tmp_w).transform(x)
        x = Normalizer(p=2.0, inputCol=tmp_w, outputCol=out).transform(x)
        return x.drop(tmp_tf, tmp_w)


def fit_tfidf(df: DataFrame, text: str, id_col: str, analyzer: str = "word",
              ngram_range: tuple[int, int] = (1, 2), min_df: int | float = 2,
              max_features: int | None = None, name: str = "tfidf",
              terms_col: str | None = None) -> TfidfModel:
    """Fit on the rows of ``df`` (the caller filters to the fit split, V5)."""
    stats = text_term_stats(df, id_col, text, analyzer, ngram_range, terms_col=terms_col)
    n_docs = df.count()
    vocab = select_vocabulary(stats, n_docs, min_df, max_features)
    got = sorted(vocab.collect(), key=lambda r: r["term"])
    return TfidfModel(terms=[r["term"] for r in got], idf=[float(r["idf"]) for r in got],
                      df=[int(r["df"]) for r in got], cf=[int(r["cf"]) for r in got],
                      n_docs=n_docs, analyzer=analyzer, ngram_range=tuple(ngram_range), name=name)


def vector_entries(df: DataFrame, vec: str, keep: list[str], idx: str = "idx", value: str = "value") -> DataFrame:
    """Long form (keep..., idx, value) of the non-zero entries of a vector column."""
    v = F.unwrap_udt(F.col(vec))  # only stored entries are taken apart; a dense vector has all its places
    at = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1, F.lit(1)))
    at = F.when(F.size(v["values"]) > 0, at)
    return (df.select(*keep, F.explode(F.arrays_zip(at.alias("i"), v["values"].alias("v"))).alias("_e"))
            .select(*keep, F.col("_e.i").alias(idx), F.col("_e.v").alias(value)).filter(F.col(value) != 0.0))


def tfidf_long(model: TfidfModel, df: DataFrame, id_col: str, text: str, keep: list[str] | None = None) -> DataFrame:
    """(id, keep..., term, tfidf) rows of the fitted model applied to ``df``."""
    keep = keep or []
    v = model.transform(df.select(id_col, text, *keep), text, "_v")
    ent = vector_entries(v, "_v", [id_col, *keep], "idx", "tfidf")
    vocab = model.vocabulary_df(df.sparkSession).select("idx", "term")
    if model.size <= BROADCAST_MAX_TERMS:  # checked bound (max_features-limited vocabularies)
        vocab = F.broadcast(vocab)
    return ent.join(vocab, "idx").select(id_col, *keep, "term", "tfidf")


def fit_tfidf_sets(df: DataFrame, group: str, sets: Mapping[str, Sequence], text: str, id_col: str,
                   analyzer: str = "word", ngram_range: tuple[int, int] = (1, 2), min_df: int | float = 2,
                   max_features: int | None = None, name: str = "tfidf",
                   terms_col: str | None = None) -> dict[str, TfidfModel]:
    """One vocabulary per fit set; a set is a list of values of ``group``.

    One pass over the texts: ``groupBy(group, term)`` (map-side combined) gives document / corpus frequencies
    per group, and a set's statistics are the sums over its groups. The table is persisted, and each set then
    costs one bounded top-k selection instead of a scan of the term rows.
    """
    from pyspark import StorageLevel

    per_group = text_term_stats(df, id_col, text, analyzer, ngram_range, [group], terms_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {r[group]: int(r["count"]) for r in df.groupBy(group).count().collect()}  # one row per group
        models = {}
        for key, groups in sets.items():
            st = per_group.filter(F.col(group).isin(*groups)).groupBy("term").agg(
                F.sum("df").alias("df"), F.sum("cf").alias("cf"))
            n_docs = sum(sizes.get(g, 0) for g in groups)
            got = sorted(select_vocabulary(st, n_docs, min_df, max_features).collect(), key=lambda r: r["term"])
            models[key] = TfidfModel(terms=[r["term"] for r in got], idf=[float(r["idf"]) for r in got],
                                     df=[int(r["df"]) for r in got], cf=[int(r["cf"]) for r in got],
                                     n_docs=n_docs, analyzer=analyzer, ngram_range=tuple(ngram_range), name=name)
        return models
    finally:
        per_group.unpersist()


def fit_tfidf_folds(df: DataFrame, fold_col: str, k: int, text: str, id_col: str, *args, **kw) -> list[TfidfModel]:
    """One vocabulary per fold, each fitted on the rows *outside* that fold."""
    got = fit_tfidf_sets(df, fold_col, {i: [j for j in range(k) if j != i] for i in range(k)}, text, id_col,
                         *args, **kw)
    return [got[i] for i in range(k)]


@dataclass
class CountBlock:
    """Several fitted vocabularies over one sparse count vector per row, indexed by their union: every fit set's
    TF-IDF block is a slice of the counts times its idf, so texts are cut into terms once."""

    name: str
    models: dict[str, TfidfModel]

    @property
    def union(self) -> list[str]:
        return sorted({t for m in self.models.values() for t in m.terms})

    def count(self, df: DataFrame, text: str) -> DataFrame:
        """Adds ``{name}_counts``; the union is bounded by sets x max_features."""
        m = next(iter(self.models.values()))
        if not self.union:
            return df.withColumn(f"{self.name}_counts", array_to_vector(F.array().cast("array<double>")))
        return with_counts(df, text, f"{self.name}_counts", self.union, m.analyzer, m.ngram_range, m.lower)

    def transform(self, df: DataFrame, key: str) -> DataFrame:
        """Adds ``{name}``: the L2-normalised TF-IDF block of fit set ``key``."""
        m, tf_col, w_col = self.models[key], f"__{self.name}_tf", f"__{self.name}_w"
        if not m.terms:
            return df.withColumn(self.name, array_to_vector(F.array().cast("array<double>")))
        at = {t: i for i, t in enumerate(self.union)}
        x = VectorSlicer(inputCol=f"{self.name}_counts", outputCol=tf_col, indices=[at[t] for t in m.terms]).transform(df)
        x = ElementwiseProduct(scalingVec=Vectors.dense(m.idf), inputCol=tf_col, outputCol=w_col).transform(x)
        return Normalizer(p=2.0, inputCol=w_col, outputCol=self.name).transform(x).drop(tf_col, w_col)
