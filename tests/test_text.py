import re

from pyspark.sql import functions as F

from brute import char_wb_terms, word_terms
from conftest import SF0
from tabtext.functions import text as tx
from tabtext.functions.ngrams import char_wb_ngrams, with_term_counts, with_word_ngrams
from tabtext.sources import standins as si

EDGE = [(1, "A b cd  EFG\tx"), (2, "one"), (3, ""), (4, None), (5, "x"), (6, "ab"),
        (7, "Café naïve 123 -- ok!"), (8, "a  b c d")]


def test_report_stats_match_python(spark):
    c = si.cases(spark, SF0)
    rows = tx.report_stats(c).select("case_id", "report", "report_len", "report_word_count",
                                     "report_unique_word_count", "report_digit_count",
                                     "report_punct_count", "report_unique_ratio").collect()
    for r in rows:
        s = r["report"]
        toks = re.findall(r"\b\w+\b", s)
        assert r["report_len"] == len(s)
        assert r["report_word_count"] == len(toks)
        assert r["report_unique_word_count"] == len(set(toks))
        assert r["report_digit_count"] == len(re.findall(r"\d", s))
        assert r["report_punct_count"] == len(re.findall(r"[^\w\s]", s))
        assert abs(r["report_unique_ratio"] - len(set(toks)) / max(len(toks), 1)) < 1e-12


def test_keyword_flags_and_interactions(spark):
    df = spark.createDataFrame([(1, "Pineal mass with HYDROCEPHALUS; ventricle"), (2, None),
                                (3, "dural tail sign, edema and enhancement")], "case_id int, report string")
    out = {r["case_id"]: r for r in tx.add_report_features(df).collect()}
    assert out[1]["has_pineal"] == 1 and out[1]["has_hydrocephalus"] == 1 and out[1]["has_ventricular"] == 1
    assert out[1]["focus_keyword_hits"] == 3 and out[1]["hydrocephalus_x_ventricular"] == 1
    assert out[2]["report"] == "" and out[2]["focus_keyword_hits"] == 0
    assert out[3]["has_extra_axial_meningioma_keywords"] == 1 and out[3]["enhancement_x_edema"] == 1


def test_word_and_char_ngrams_edge_cases(spark):
    df = spark.createDataFrame(EDGE, "id int, t string")
    x = with_word_ngrams(df, "t", "w", 1, 2).withColumn("c", char_wb_ngrams(F.col("t")))
    for r in x.collect():
        assert sorted(r["w"]) == sorted(word_terms(r["t"])), r["t"]
        assert sorted(r["c"]) == sorted(char_wb_terms(r["t"])), r["t"]


def test_ngrams_match_python_on_documents(spark):
    d = si.table(spark, SF0, "documents").select("doc_id", "text")
    x = with_word_ngrams(d, "text", "w").withColumn("c", char_wb_ngrams(F.col("text")))
    for r in x.collect():
        assert sorted(r["w"]) == sorted(word_terms(r["text"]))
        assert sorted(r["c"]) == sorted(char_wb_terms(r["text"]))


def test_term_counts_in_row(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b", "c", "b"]), (2, []), (3, ["z"])], "id int, t array<string>")
    out = {r["id"]: {e["term"]: e["n"] for e in r["tc"]} for r in with_term_counts(df, "t", "tc").collect()}
    assert out == {1: {"a": 1, "b": 3, "c": 1}, 2: {}, 3: {"z": 1}}
