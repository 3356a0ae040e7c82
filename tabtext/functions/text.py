"""Report text statistics and keyword flags as JVM column expressions.

Python's Unicode ``\\w`` is matched with ``[\\p{L}\\p{N}_]`` (same counts in
Java regex, RE2 and Python ``re``); ``\\s`` is widened with ``\\p{Z}`` and the
C0/C1 separators Python treats as whitespace.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"
DIGIT = r"\p{Nd}"
SPACE_CLASS = r"\s\p{Z}\x{1c}-\x{1f}\x{85}"
PUNCT = r"[^\p{L}\p{N}_" + SPACE_CLASS + "]"

# ---- fixed values: keyword dictionary of the reference's report features ----
# output column -> pattern searched in the lower-cased report
MEDICAL_KEYWORDS: dict[str, str] = {
    "has_enhancement": "enhancement",
    "has_edema": "edema",
    "has_midline_shift": "midline",
    "has_hydrocephalus": "hydrocephalus",
    "has_multiple": "multiple",
    "has_diffusion_restrict": "diffusion|restrict",
    "has_cystic": "cyst|cystic",
    "has_extra_axial_meningioma_keywords": "dural tail|extra-axial|parasagittal|convexity|falx|meningioma",
    "has_pineal": "pineal",
    "has_sellar": "sellar|suprasellar|pituitary",
    "has_ventricular": "ventricle|ventricular",
}
# sums and products of flags
MEDICAL_SUMS: dict[str, list[str]] = {
    "focus_keyword_hits": ["has_pineal", "has_sellar", "has_hydrocephalus", "has_ventricular"],
}
MEDICAL_PRODUCTS: dict[str, list[str]] = {
    "enhancement_x_edema": ["has_enhancement", "has_edema"],
    "hydrocephalus_x_ventricular": ["has_hydrocephalus", "has_ventricular"],
}
# ---- end of fixed values ----

# A second dictionary over words that occur in the fixture documents, so the
# flag operator is exercised with non-zero hits.
DOCUMENT_KEYWORDS: dict[str, str] = {
    "has_license": "license",
    "has_the": "the",
    "has_secret": "key|token",
    "has_copyright": "copyright",
}
DOCUMENT_SUMS = {"doc_keyword_hits": ["has_license", "has_secret", "has_copyright"]}
DOCUMENT_PRODUCTS = {"license_x_the": ["has_license", "has_the"]}


def clean_report(col: str | Column, lower: bool = True) -> Column:
    """null -> '', to string, optionally lower-case."""
    c = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")
    return F.lower(c) if lower else c


def tokens(col: Column) -> Column:
    """Runs of word characters."""
    return F.regexp_extract_all(col, F.lit(WORD), 0)


def report_stats(df: DataFrame, col: str = "report") -> DataFrame:
    """Adds T3-T8 over the cleaned report and replaces ``col`` with it."""
    r = clean_report(col)
    df = df.withColumn(col, r).withColumn("_tok", tokens(F.col(col)))
    words = F.size("_tok").cast("bigint")
    uniq = F.size(F.array_distinct("_tok")).cast("bigint")
    return df.withColumns({
        "report_len": F.char_length(col).cast("bigint"),
        "report_word_count": words,
        "report_unique_word_count": uniq,
        "report_unique_ratio": uniq / F.greatest(words, F.lit(1)).cast("double"),
        "report_digit_count": F.regexp_count(col, F.lit(DIGIT)).cast("bigint"),
        "report_punct_count": F.regexp_count(col, F.lit(PUNCT)).cast("bigint"),
    }).drop("_tok")


def keyword_flags(df: DataFrame, col: str = "report",
                  patterns: Mapping[str, str] = MEDICAL_KEYWORDS) -> DataFrame:
    """0/1 int column per pattern: regex *search* in ``col``."""
    return df.withColumns({
        name: F.col(col).rlike(pat).cast("int") for name, pat in patterns.items()
    })


def keyword_interactions(df: DataFrame,
                         sums: Mapping[str, Sequence[str]] = MEDICAL_SUMS,
                         products: Mapping[str, Sequence[str]] = MEDICAL_PRODUCTS) -> DataFrame:
    """Integer sums and products of flag columns."""
    exprs: dict[str, Column] = {}
    for name, cols in sums.items():
        e = F.lit(0)
        for c in cols:
            e = e + F.col(c)
        exprs[name] = e.cast("int")
    for name, cols in products.items():
        e = F.lit(1)
        for c in cols:
            e = e * F.col(c)
        exprs[name] = e.cast("int")
    return df.withColumns(exprs)


def add_report_features(df: DataFrame, col: str = "report",
                        patterns: Mapping[str, str] = MEDICAL_KEYWORDS,
                        sums: Mapping[str, Sequence[str]] = MEDICAL_SUMS,
                        products: Mapping[str, Sequence[str]] = MEDICAL_PRODUCTS,
                        stats: bool = True) -> DataFrame:
    """The whole report feature block in one projection.

    ``stats=False`` gives the shorter variants (clean + flags only).
    """
    df = report_stats(df, col) if stats else df.withColumn(col, clean_report(col))
    df = keyword_flags(df, col, patterns)
    return keyword_interactions(df, sums, products)
