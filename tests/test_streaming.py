import os

from conftest import SF0
from tabtext.functions import text as tx
from tabtext.sources import standins as si
from tabtext.streaming.features import start, stream_report_features


def test_stream_matches_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    si.cases(spark, SF0).select("case_id", "report").write.parquet(src)
    stream = spark.readStream.schema("case_id bigint, report string").parquet(src)
    q = start(spark, stream_report_features(stream), "report_features_test", fmt="memory")
    q.awaitTermination(120)
    got = {r["case_id"]: r for r in spark.sql("SELECT * FROM report_features_test").collect()}
    want = {r["case_id"]: r for r in tx.add_report_features(spark.read.parquet(src)).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k].asDict() == want[k].asDict()
