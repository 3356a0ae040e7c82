from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF0
from tabtext.operators import models as MO


def _toy(spark):
    rows = []
    for i in range(60):
        c = i % 3
        rows.append((i, c, Vectors.dense([float(c) + (i % 5) * 0.01, float(i % 7), 1.0 if c == 2 else 0.0]), 1.0))
    schema = T.StructType([T.StructField("case_id", T.IntegerType()), T.StructField("y", T.IntegerType()),
                           T.StructField("features", VectorUDT()), T.StructField("weight", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def test_models_give_normalised_probabilities(spark):
    df = _toy(spark)
    for kind, params in [("rf", {"num_trees": 10}), ("gbt", {"n_estimators": 3, "num_leaves": 4}),
                         ("mlp", {"n_features": 3, "hidden": (4,), "max_iter": 20})]:
        m = MO.fit_classifier(df, kind, 4, params)
        out = m.predict(df).select("p", "pred").collect()
        for r in out:
            assert len(r["p"]) == 4 and abs(sum(r["p"]) - 1.0) < 1e-9
            assert r["pred"] == r["p"].index(max(r["p"]))


def test_network_scores_blocks_of_rows(spark):
    """Probabilities of the network are those of pyspark.ml, whose model scores a row at a time and is not run."""
    df = _toy(spark)
    m = MO.fit_classifier(df, "mlp", 4, {"n_features": 3, "hidden": (4, 3), "max_iter": 20})
    more = [Vectors.sparse(3, []), Vectors.sparse(3, [0, 2], [1e4, -1e4]), Vectors.dense([0.0, -2.5, 7.0]), Vectors.sparse(3, [1], [0.5])]
    more = spark.createDataFrame([(i, i, more[i % 4], None) for i in range(1300)], df.schema)
    x = df.union(more).repartition(3)
    want = {r["case_id"]: r for r in m.model.transform(x.filter("weight IS NULL")).collect()}
    got = m.predict(x).filter("weight IS NULL").collect()
    assert len(got) == len(want) == 1300
    for r in got:
        w = want[r["case_id"]]
        assert r["pred"] == w["prediction"] and max(abs(a - b) for a, b in zip(r["p"], w["probability"])) < 1e-9
    assert m.predict(x.filter("case_id < 0")).count() == 0
    plan = m.predict(x)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "probability" not in plan


def test_importance_top_order(spark):
    top = MO.importance_top(_toy(spark), n=2, trees=5)
    assert len(top) == 2 and len(set(top)) == 2


def test_entry_contract(spark):
    import __spark_entry__ as E

    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs) and len(qs) >= 60
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["case_id", "Overall_class"] and len(rows) > 0
    assert all(r["Overall_class"].startswith("class_") for r in rows)


def test_oof_each_case_once(spark):
    from tabtext.plans import q_models

    df = q_models.oof_proba(spark, SF0)
    rows = df.collect()
    ids = [r["case_id"] for r in rows]
    assert len(ids) == len(set(ids)) and {r["fold"] for r in rows} <= set(range(5))
    assert df.filter(F.col("p_max") > 1.0).count() == 0


def test_workflow_gbt_path(spark):
    from tabtext.operators import models as MO
    from tabtext.plans import workflow as W

    s = W.Settings(model="gbt", model_params=dict(MO.GBT_FIXED_PARAMS, n_estimators=2), run_cv=False,
                   run_oof=False)
    out = W.run(spark, SF0, s)
    sub = out["submission"].collect()
    assert sub and all(r["Overall_class"] in out["labels"] for r in sub)
    m = out["val_metrics"].first()
    assert 0.0 <= m["blend"] <= 1.0


def test_merge_modalities_strategies(spark):
    from tabtext.operators import joins as J

    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "case_id int, a double")
    b = spark.createDataFrame([(2, 20.0), (3, 30.0)], "case_id int, b double")
    j = sorted(tuple(r) for r in J.merge_modalities([a, b], strategy="join").collect())
    u = sorted(tuple(r) for r in J.merge_modalities([a, b], strategy="union").select("case_id", "a", "b").collect())
    assert j == u == [(1, 1.0, None), (2, 2.0, 20.0), (3, None, 30.0)]
    c = spark.createDataFrame([(2, "x"), (2, "y"), (4, None)], "case_id int, c string")
    dup = a.unionByName(a)
    for frames in ([dup, b, c], [c, dup], [b, c, a, dup.withColumnRenamed("a", "z")]):
        j = J.merge_modalities(frames, strategy="join")
        u = J.merge_modalities(frames, strategy="union")
        assert j.columns == u.columns
        assert sorted(map(str, j.collect())) == sorted(map(str, u.collect()))  # SQL fan-out
    plan = J.merge_modalities([dup, b, c], strategy="union")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def _nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def test_texts_do_not_shuffle(spark):
    """No exchange of these plans carries the text, also where no side is broadcast."""
    from tabtext.plans.registry import QUERIES, load_all

    load_all()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("report_stats", "join_clinical_left", "fill_train_median"):
            plan = QUERIES[name](spark, SF0)._jdf.queryExecution().optimizedPlan()
            joins = [n for n in _nodes(plan) if n.nodeName() == "Join"]
            assert joins
            for j in joins:
                for side in (j.left(), j.right()):
                    wide = [side.output().apply(i).name() for i in range(side.output().size())]
                    assert not {"report", "text", "js_plain"} & set(wide), (name, wide)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
