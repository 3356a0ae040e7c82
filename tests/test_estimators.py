"""Fitted estimators: saved, loaded in another Python process, equal rows."""

import json
import os
import subprocess
import sys

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tabtext.operators import estimators as ES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LOAD = """
import json, sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate())
from pyspark.ml import PipelineModel
m = PipelineModel.load(sys.argv[1])
rows = m.transform(spark.read.parquet(sys.argv[2])).orderBy("case_id").collect()
print("ROWS " + json.dumps([[r.case_id, r.a, r.b, r.s, r.tab.toArray().tolist(), r.words.toArray().tolist()] for r in rows]))
"""


def frame(spark):
    rows = [(i, None if i % 4 == 0 else float(i), i % 3 * 1.5, None if i % 5 == 0 else "xyz"[i % 3], f"word{i % 4} common text {i % 2}",
             "train" if i < 20 else "test") for i in range(30)]
    return spark.createDataFrame(rows, "case_id int, a double, b double, s string, report string, split string")


def pipeline():
    return Pipeline(stages=[ES.Fill(inputCols=["a", "s"]), ES.Scale(inputCols=["a", "b"]),
                            ES.OneHot(inputCols=["a", "b", "s"], outputCol="tab"),
                            ES.Tfidf(inputCols=["report", "case_id"], outputCol="words", maxFeatures=5)])


def flat(rows):
    return [[r.case_id, r.a, r.b, r.s, r.tab.toArray().tolist(), r.words.toArray().tolist()] for r in rows]


def test_second_session_gives_equal_rows(spark, tmpdir_path):
    df = frame(spark)
    model = pipeline().fit(df.where("split = 'train'"))
    want = flat(model.transform(df).orderBy("case_id").collect())
    path, data = os.path.join(tmpdir_path, "model"), os.path.join(tmpdir_path, "data")
    model.write().overwrite().save(path)
    df.write.parquet(data)
    assert flat(PipelineModel.load(path).transform(df).orderBy("case_id").collect()) == want
    out = subprocess.run([sys.executable, "-c", LOAD, path, data], capture_output=True, text=True, timeout=200,
                         env=os.environ | {"PYTHONPATH": ROOT}, check=True).stdout
    assert json.loads(next(x for x in out.splitlines() if x.startswith("ROWS "))[5:]) == want


def test_unfitted_pipeline_round_trip(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "pipeline")
    pipeline().write().overwrite().save(path)
    df = frame(spark)
    a, b = (p.fit(df).transform(df).orderBy("case_id").collect() for p in (pipeline(), Pipeline.load(path)))
    assert flat(a) == flat(b)


def test_levels_from_train_only(spark):
    df = frame(spark).withColumn("s", F.when(F.col("split") == "test", F.lit("new")).otherwise(F.col("s")))
    m = ES.OneHot(inputCols=["s"], outputCol="tab", levelsFrom="split = 'train'").fit(df)
    assert m.fitted.levels == {"s": ["x", "y", "z"]}
    assert all(r.tab.toArray().sum() == 0 for r in m.transform(df).where("split = 'test'").collect())
    assert "new" in ES.OneHot(inputCols=["s"], outputCol="tab").fit(df).fitted.levels["s"]
