"""The queries with SQL equal it on the smallest tables; the others run and keep their row counts."""

import duckdb
import pytest

from scripts.check import TABLES, rows_of
from tabtext.llm import queries  # noqa: F401
from tabtext.llm.registry import ORACLES, QUERIES

SF0 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF0)
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


@pytest.mark.parametrize("name,rows", [("op2_language_id", "documents"), ("op3_token_counts", "documents"),
                                       ("op4_simhash_near_dedup", "documents"), ("op9_html_extraction", "pages")])
def test_one_row_per_input(spark, name, rows):
    assert QUERIES[name](spark, SF0).count() == spark.read.parquet(f"{SF0}/{rows}.parquet").count()


def test_pipeline_stages(spark):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF0}/documents.parquet")
    whole = {r.doc_id: r for r in docs.collect()}
    at = docs
    for name, stage in C.STAGES[:-1]:
        before = at.count()
        at = stage(spark, at, SF0)
        assert at.columns == docs.columns
        rows = at.collect()
        assert all(whole[r.doc_id] == r for r in rows) and len({r.doc_id for r in rows}) == len(rows)
        assert len(rows) == before if name == "mixing" else 0 < len(rows) <= before
    packed = C.STAGES[-1][1](spark, at, SF0).collect()
    assert {d for r in packed for d in r.doc_ids} == {r.doc_id for r in rows}


def test_pipeline_on_empty_table(spark):
    import corpus_pipeline as C

    at = spark.read.parquet(f"{SF0}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        at = stage(spark, at, SF0)
    assert at.count() == 0


def test_pipeline_keeps_the_mix_in_the_token_rows(spark):
    """Stages through Parquet: the first documents of packed rows follow the mix, so every prefix has each source's share."""
    import corpus_pipeline as C
    from tabtext.llm import mixing, packing
    from tabtext.session import written

    rows = [(i, f"word{i} " * (1 + 40 * (i % 3)), "en", "abc"[min(2, i // 400)], 1) for i in range(900)]
    docs = written(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(7))
    mixed = written(C.mix(spark, docs, SF0))
    order = [r.source for r in packing.in_file_order(mixed).collect()]
    weights = mixing.default_weights(docs)
    total = sum(weights.values())
    full = min(sum(1 for r in rows if r[3] == s) * total / w for s, w in weights.items())  # until a source runs dry
    for n in range(mixing.BLOCK, int(full), 7):
        for s, w in weights.items():
            assert abs(order[:n].count(s) - n * w / total) <= 2 * mixing.BLOCK
    place = {}
    for k, r in enumerate(packing.in_file_order(mixed).collect()):
        place.setdefault(r.doc_id, k)
    packed = C.token_output(spark, mixed, SF0).orderBy("row_id").collect()
    firsts = [min(place[d] for d in r.doc_ids) for r in packed]
    assert firsts == sorted(firsts)


def test_mixing_rows_without_ids(spark):
    """Rows with null or repeated ids have places of their own."""
    from tabtext.llm import mixing

    rows = [(None, f"a{i}", "a") for i in range(200)] + [(7, f"b{i}", "b") for i in range(200)] + [(None, "same", "c")] * 200
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(str(r) for r in spark.createDataFrame(rows, "doc_id bigint, text string, source string").collect())
    runs = max(len(list(g)) for _, g in __import__("itertools").groupby(got, key=lambda r: r.source))
    assert runs <= 2 * mixing.BLOCK
