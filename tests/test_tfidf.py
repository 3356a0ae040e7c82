from brute import char_wb_terms, tfidf, word_terms
from conftest import SF0
from tabtext.operators import tfidf as tf
from tabtext.sources import standins as si


def _check(spark, analyzer, fn, rng, max_features):
    c = si.cases(spark, SF0).select("case_id", "split", "report")
    rows = c.collect()
    fit = {r["case_id"]: r["report"] for r in rows if r["split"] == "train"}
    allr = {r["case_id"]: r["report"] for r in rows}
    want, vocab = tfidf(fit, allr, lambda t: fn(t, *rng), 2, max_features)
    m = tf.fit_tfidf(c.filter("split = 'train'"), "report", "case_id", analyzer, rng, 2, max_features)
    assert m.terms == vocab
    got = {}
    for r in tf.tfidf_long(m, c, "case_id", "report").collect():
        got.setdefault(r["case_id"], {})[r["term"]] = r["tfidf"]
    for d, w in want.items():
        g = got.get(d, {})
        assert set(g) == set(w), d
        for t, v in w.items():
            assert abs(g[t] - v) < 1e-9


def test_word_tfidf_matches_brute_force(spark):
    _check(spark, "word", word_terms, (1, 2), 2500)


def test_char_tfidf_matches_brute_force(spark):
    _check(spark, "char_wb", char_wb_terms, (3, 5), 1200)


def test_empty_vocabulary(spark):
    df = spark.createDataFrame([(1, "alpha"), (2, "beta")], "case_id int, report string")
    m = tf.fit_tfidf(df, "report", "case_id", "word", (1, 2), 2, 10)
    assert m.size == 0
    out = m.transform(df, "report", "v").collect()
    assert all(r["v"].size == 0 for r in out)


def test_fold_algebra_equals_refit(spark):
    from pyspark.sql import functions as F

    c = si.cases(spark, SF0).select("case_id", "report").withColumn("fold", (F.col("case_id") % 3).cast("int"))
    c = tf.with_terms(c, "report", "wt", "word", (1, 2))
    models = tf.fit_tfidf_folds(c, "fold", 3, "report", "case_id", "word", (1, 2), 2, 300, terms_col="wt")
    for i in range(3):
        ref = tf.fit_tfidf(c.filter(F.col("fold") != i), "report", "case_id", "word", (1, 2), 2, 300)
        assert models[i].terms == ref.terms and models[i].n_docs == ref.n_docs
        assert all(abs(a - b) < 1e-12 for a, b in zip(models[i].idf, ref.idf))


def test_count_block_equals_separate_fits(spark):
    c = si.cases(spark, SF0).select("case_id", "split", "report")
    sets = {"train": ["train"], "both": ["train", "val"], "none": ["absent"]}
    for analyzer, rng, top in (("word", (1, 2), 300), ("char_wb", (3, 5), 200)):
        models = tf.fit_tfidf_sets(c, "split", sets, "report", "case_id", analyzer, rng, 2, top)
        block = tf.CountBlock("b", models)
        counted = block.count(c, "report").drop("report")
        assert models["none"].terms == [] and block.transform(counted, "none").first()["b"].size == 0
        for key in ("train", "both"):
            ref = tf.fit_tfidf(c.filter(c["split"].isin(*sets[key])), "report", "case_id", analyzer, rng, 2, top)
            assert models[key].terms == ref.terms
            got = {r["case_id"]: r["b"].toArray() for r in block.transform(counted, key).collect()}
            for r in ref.transform(c, "report", "v").select("case_id", "v").collect():
                assert abs(got[r["case_id"]] - r["v"].toArray()).max() < 1e-12


def test_word_grams_counted_by_token_numbers(spark, monkeypatch):
    """The same statistics as term by term, in pieces of a few tokens, with groups, repeated rows and empty texts."""
    from tabtext.functions import ngrams as N

    monkeypatch.setattr(N, "HELD_TOKENS", 3)
    texts = ["Aa bb aa bb cc", None, "", "x y", "été ÉTÉ naïve_1", "bb aa", "bb aa", "aa", "ábc aa, bb!"]
    rows = [(i % 5, ("u", None, "v")[i % 3], t) for i, t in enumerate(texts * 2)]
    df = spark.createDataFrame(rows, "case_id int, g string, report string").repartition(3)
    for lo, hi in ((1, 2), (1, 1), (2, 2)):
        for group in ([], ["g"]):
            want = tf.term_stats(tf.term_rows(df, "case_id", "report", "word", (lo, hi), keep=group), group)
            got = tf.text_term_stats(df, "case_id", "report", "word", (lo, hi), group)
            assert got.dtypes == want.dtypes
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
            assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()


def test_char_grams_of_many_words_at_once(spark, monkeypatch):
    """Windows over all words give the n-grams of each word, also in pieces, with groups, repeated rows, empty texts and odd characters."""
    from tabtext.functions import ngrams as N

    words = ["a", "bb", "ccc", "ab!c", "été", "naïve_1", "\U0001F600x\U0001F600", "\u0000z", "abcabcabc"]
    for lo, hi in ((3, 5), (3, 3), (2, 4), (4, 6)):
        terms, off, numbers = N.grams_of_words(words, lo, hi)
        assert len(set(terms)) == len(terms)
        for i, w in enumerate(words):
            assert sorted(terms[j] for j in numbers[off[i]:off[i + 1]]) == sorted(N.grams_of_word(w, lo, hi))
    monkeypatch.setattr(N, "HELD_WORDS", 4)
    monkeypatch.setattr(N, "HELD_GRAMS", 10)
    texts = ["Aa bb aa  bb\tcc", None, "", " ", "x y", "été ÉTÉ naïve_1 " + "\U0001F600" * 3, "bb aa", "bb aa", "aa", "ábc aa, bb!"]
    rows = [(i % 5, ("u", None, "v")[i % 3], t) for i, t in enumerate(texts * 2)]
    df = spark.createDataFrame(rows, "case_id int, g string, report string").repartition(3)
    for group in ([], ["g"]):
        want = tf.term_stats(tf.term_rows(df, "case_id", "report", "char_wb", (3, 5), keep=group), group)
        got = tf.text_term_stats(df, "case_id", "report", "char_wb", (3, 5), group)
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
    voc = sorted({r["term"] for r in want.collect()})[::2]
    a, b = (tf.with_counts(x, "report", "v", voc, "char_wb", (3, 5), terms_col=c).select("report", "v").collect()
            for x, c in ((df, None), (tf.with_terms(df, "report", "terms", "char_wb", (3, 5)), "terms")))
    assert sorted(map(str, a)) == sorted(map(str, b))
