"""Queries over report text: statistics, keyword flags, n-grams, TF-IDF."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabtext.functions import text as tx
from tabtext.operators import tfidf as tf
from tabtext.plans import sql as S
from tabtext.plans.registry import query
from tabtext.sources import standins as si

R6 = 6

# ---------------------------------------------------------------- T1-T8 ----

_STATS_SQL = S.with_(S.CASES, "r AS (SELECT case_id, split, label, lower(coalesce(report, '')) AS r FROM cases)") + f"""
SELECT case_id, split, label,
       CAST(length(r) AS BIGINT) AS report_len,
       CAST(len(regexp_extract_all(r, '{S.WORD_RE}')) AS BIGINT) AS report_word_count,
       CAST(len(list_distinct(regexp_extract_all(r, '{S.WORD_RE}'))) AS BIGINT) AS report_unique_word_count,
       round(len(list_distinct(regexp_extract_all(r, '{S.WORD_RE}')))
             / greatest(len(regexp_extract_all(r, '{S.WORD_RE}')), 1), 6) AS report_unique_ratio,
       CAST(len(regexp_extract_all(r, '{S.DIGIT_RE}')) AS BIGINT) AS report_digit_count,
       CAST(len(regexp_extract_all(r, '{S.PUNCT_RE}')) AS BIGINT) AS report_punct_count
FROM r"""


@query("report_stats", _STATS_SQL)
def report_stats(spark, sf_dir):
    """Cleaned report length, word / unique-word counts, ratio, digit
    and punctuation counts for every case."""
    df = tx.report_stats(si.cases(spark, sf_dir, with_label=False)).drop("report", "label")
    df = df.join(si.labels_of(spark, sf_dir), "case_id", "left")
    return df.select("case_id", "split", "label", "report_len", "report_word_count",
                     "report_unique_word_count", F.round("report_unique_ratio", R6).alias("report_unique_ratio"),
                     "report_digit_count", "report_punct_count")


def _flag_sql(patterns: dict[str, str]) -> str:
    return ",\n       ".join(f"CAST(regexp_matches(r, '{p}') AS INTEGER) AS {n}" for n, p in patterns.items())


_FLAGS_SQL = S.with_(S.CASES, "r AS (SELECT case_id, split, lower(coalesce(report, '')) AS r FROM cases)") + f"""
SELECT case_id, split,
       {_flag_sql(tx.MEDICAL_KEYWORDS)},
       {_flag_sql(tx.DOCUMENT_KEYWORDS)}
FROM r"""


@query("keyword_flags", _FLAGS_SQL)
def keyword_flags(spark, sf_dir):
    """0/1 keyword flags (medical dictionary + a dictionary of words
    that occur in the fixture documents)."""
    df = si.cases(spark, sf_dir, with_label=False).withColumn("report", tx.clean_report("report"))
    df = tx.keyword_flags(df, "report", tx.MEDICAL_KEYWORDS)
    df = tx.keyword_flags(df, "report", tx.DOCUMENT_KEYWORDS)
    return df.select("case_id", "split", *tx.MEDICAL_KEYWORDS, *tx.DOCUMENT_KEYWORDS)


def _inter_sql(patterns, sums, products) -> str:
    flag = {n: f"CAST(regexp_matches(r, '{p}') AS INTEGER)" for n, p in patterns.items()}
    out = [f"CAST({' + '.join(flag[c] for c in cols)} AS INTEGER) AS {n}" for n, cols in sums.items()]
    out += [f"CAST({' * '.join(flag[c] for c in cols)} AS INTEGER) AS {n}" for n, cols in products.items()]
    return ",\n       ".join(out)


_INTER_SQL = S.with_(S.CASES, "r AS (SELECT case_id, lower(coalesce(report, '')) AS r FROM cases)") + f"""
SELECT case_id,
       {_inter_sql(tx.MEDICAL_KEYWORDS, tx.MEDICAL_SUMS, tx.MEDICAL_PRODUCTS)},
       {_inter_sql(tx.DOCUMENT_KEYWORDS, tx.DOCUMENT_SUMS, tx.DOCUMENT_PRODUCTS)}
FROM r"""


@query("keyword_interactions", _INTER_SQL)
def keyword_interactions(spark, sf_dir):
    """Keyword hit sums and flag products, both dictionaries."""
    df = tx.add_report_features(si.cases(spark, sf_dir, with_label=False), stats=False)
    df = tx.add_report_features(df, patterns=tx.DOCUMENT_KEYWORDS, sums=tx.DOCUMENT_SUMS,
                                products=tx.DOCUMENT_PRODUCTS, stats=False)
    return df.select("case_id", *tx.MEDICAL_SUMS, *tx.MEDICAL_PRODUCTS, *tx.DOCUMENT_SUMS, *tx.DOCUMENT_PRODUCTS)


# ------------------------------------------------------------ n-grams ------

WORD_GRAMS_CTE = f"""
toks AS (SELECT case_id, split, regexp_extract_all(lower(coalesce(report, '')), '{S.WORD2_RE}') AS tk FROM cases),
grams AS (
  SELECT case_id, split, unnest(tk) AS term FROM toks
  UNION ALL
  SELECT case_id, split, unnest(list_transform(range(1, len(tk)), lambda i: tk[i] || ' ' || tk[i + 1])) AS term
  FROM toks WHERE len(tk) >= 2
),
tf AS (SELECT case_id, split, term, CAST(count(*) AS BIGINT) AS n FROM grams GROUP BY ALL)"""

CHAR_GRAMS_CTE = f"""
words AS (
  SELECT case_id, split,
         unnest(list_filter(regexp_split_to_array(lower(coalesce(report, '')), '{S.SPACE_RE}'), lambda w: w <> '')) AS w
  FROM cases
),
padded AS (SELECT case_id, split, ' ' || w || ' ' AS p, length(' ' || w || ' ') AS plen FROM words),
ns AS (SELECT unnest([3, 4, 5]) AS n),
grams AS (
  SELECT case_id, split, unnest(list_transform(range(1, greatest(plen - n + 1, 1) + 1), lambda i: substr(p, i, n))) AS term
  FROM padded, ns WHERE n = 3 OR plen >= n
),
tf AS (SELECT case_id, split, term, CAST(count(*) AS BIGINT) AS n FROM grams GROUP BY ALL)"""


@query("word_ngrams", S.with_(S.CASES, WORD_GRAMS_CTE) + "\nSELECT case_id, term, n FROM tf")
def word_ngrams(spark, sf_dir):
    """V2: word 1-2-gram counts per case (tokens of >= 2 word characters)."""
    return tf.term_rows(si.cases(spark, sf_dir, with_label=False), "case_id", "report", "word", (1, 2))


@query("char_wb_ngrams", S.with_(S.CASES, CHAR_GRAMS_CTE) + """
SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(n) AS BIGINT) AS cf FROM tf GROUP BY term""")
def char_wb_ngrams(spark, sf_dir):
    """V3 + G11: char_wb 3-5-gram document and corpus frequency over all cases."""
    stats = tf.text_term_stats(si.cases(spark, sf_dir, with_label=False), "case_id", "report", "char_wb", (3, 5))
    return stats.select("term", F.col("df").cast("bigint").alias("df"),
                                      F.col("cf").cast("bigint").alias("cf"))


@query("term_df", S.with_(S.CASES, WORD_GRAMS_CTE) + """
SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(n) AS BIGINT) AS cf FROM tf WHERE split = 'train' GROUP BY term""")
def term_df(spark, sf_dir):
    """Word-term document / corpus frequency over the train split."""
    rows = tf.term_rows(si.cases(spark, sf_dir, with_label=False).filter("split = 'train'"), "case_id", "report", "word", (1, 2))
    return tf.term_stats(rows).select("term", F.col("df").cast("bigint").alias("df"),
                                      F.col("cf").cast("bigint").alias("cf"))


def _vocab_sql(grams_cte: str, max_features: int) -> str:
    return S.with_(S.CASES, grams_cte, f"""
nd AS (SELECT count(*) AS n_docs FROM cases WHERE split = 'train'),
st AS (SELECT term, count(*) AS df, sum(n) AS cf FROM tf WHERE split = 'train' GROUP BY term),
voc AS (SELECT term, df, cf, ln((1 + n_docs) / (1 + df)) + 1 AS idf FROM st, nd
        WHERE df >= 2 ORDER BY cf DESC, term ASC LIMIT {max_features})""")


@query("vocab_topk", _vocab_sql(WORD_GRAMS_CTE, 2500) + """
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx,
       CAST(df AS BIGINT) AS df, CAST(cf AS BIGINT) AS cf, round(idf, 6) AS idf FROM voc""")
def vocab_topk(spark, sf_dir):
    """O3 + V4: the fitted word vocabulary (min_df 2, top 2,500 by corpus
    frequency, alphabetical index) with smooth idf, fitted on train."""
    train = si.cases(spark, sf_dir, with_label=False).filter("split = 'train'")
    m = tf.fit_tfidf(train, "report", "case_id", **tf.WORD_DEFAULTS)
    return m.vocabulary_df(spark).withColumn("idf", F.round("idf", R6))


def _tfidf_sql(grams_cte: str, max_features: int) -> str:
    return _vocab_sql(grams_cte, max_features) + """,
w AS (SELECT tf.case_id, tf.split, tf.term, tf.n * voc.idf AS w FROM tf JOIN voc USING (term))
SELECT case_id, split, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY case_id)), 6) AS tfidf FROM w"""


def _tfidf_query(spark, sf_dir, defaults):
    c = si.cases(spark, sf_dir, with_label=False)
    m = tf.fit_tfidf(c.filter("split = 'train'"), "report", "case_id", **defaults)
    out = tf.tfidf_long(m, c, "case_id", "report", keep=["split"])
    return out.withColumn("tfidf", F.round("tfidf", R6))


@query("tfidf_word", _tfidf_sql(WORD_GRAMS_CTE, 2500))
def tfidf_word(spark, sf_dir):
    """V4/V5 word block: fitted on train, applied to every split, L2 per case."""
    return _tfidf_query(spark, sf_dir, tf.WORD_DEFAULTS)


@query("tfidf_char", _tfidf_sql(CHAR_GRAMS_CTE, 1200))
def tfidf_char(spark, sf_dir):
    """V4/V5 char_wb block: fitted on train, applied to every split."""
    return _tfidf_query(spark, sf_dir, tf.CHAR_DEFAULTS)
