import os

import pytest
from pyspark.sql import functions as F

from tabtext.operators import schema as P
from tabtext.sources import cases as C
from tabtext.sources import files as FS


def _write(path, text, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)


def test_case_json_defaults_keys_and_unwrap(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "train.json")
    _write(p, '{"1": {"report": "A b", "available_modalities": ["t1", "t2"], "Overall_class": "G"},'
              ' "2.0": {"report": {"finding": "F text"}},'
              ' "x": {"report": "bad key"},'
              ' "": {"report": "empty key"},'
              ' "3": {"report": {"impression": "no finding"}, "Overall_class": "M"},'
              ' "4": {}}')
    rows = {r["case_id"]: r for r in C.read_case_json(spark, p, unwrap_finding=True, bad_keys="drop").collect()}
    assert set(rows) == {1, 2, 3, 4}
    assert rows[1]["report"] == "A b" and rows[1]["n_modalities"] == 2 and rows[1]["Overall_class"] == "G"
    assert rows[2]["report"] == "F text" and rows[2]["Overall_class"] is None
    assert rows[3]["report"] == "" and rows[4]["report"] == "" and rows[4]["n_modalities"] == 0
    plain = {r["case_id"]: r for r in C.read_case_json(spark, p, bad_keys="drop").collect()}
    assert '"finding"' in plain[2]["report"]  # not unwrapped in the main-pipeline form


def test_split_routing(spark, tmpdir_path):
    a, b = os.path.join(tmpdir_path, "train.json"), os.path.join(tmpdir_path, "test.json")
    _write(a, '{"1": {"report": "x", "Overall_class": "A"}}')
    _write(b, '{"9": {"report": "y"}}')
    df = C.read_splits(spark, {"train": a, "test": b})
    assert sorted((r["case_id"], r["split"]) for r in df.collect()) == [(1, "train"), (9, "test")]


def test_event_props_json_without_numeric_keys(spark):
    df = spark.createDataFrame([('{"k": 69}',)], "props string")
    assert C.explode_case_map(df, "props", bad_keys="drop").count() == 0
    with pytest.raises(Exception, match="no whole number"):
        C.explode_case_map(df, "props").collect()


def test_ids_are_exact(spark):
    df = spark.createDataFrame([('{"9007199254740993": {}, "9007199254740992.0": {}, "9223372036854775807": {}}',)], "js string")
    assert sorted(r["case_id"] for r in C.explode_case_map(df, "js").collect()) == [2 ** 53, 2 ** 53 + 1, 2 ** 63 - 1]
    for bad in ("1.7", "abc", "9223372036854775808"):
        df = spark.createDataFrame([('{"%s": {}}' % bad,)], "js string")
        with pytest.raises(Exception, match="no whole number"):
            C.explode_case_map(df, "js").collect()
    rad = spark.createDataFrame([("9007199254740993", 1.0), ("9007199254740992", 2.0), ("2.7", 3.0), ("q", 4.0)], "case_id string, rad_a double")
    assert sorted(r["case_id"] for r in FS.clean_modality_frame(rad, "m").collect()) == [2, 2 ** 53, 2 ** 53 + 1]


def test_optional_clinical_csv(spark, tmpdir_path):
    assert FS.read_optional_csv(spark, os.path.join(tmpdir_path, "nope.csv")) is None
    p = os.path.join(tmpdir_path, "train_patient_info.csv")
    _write(p, "case_id,age,Sex\n1,40,F\n2,,M\n")
    df = FS.read_optional_csv(spark, p)
    assert df.count() == 2 and "Sex" in df.columns


def test_radiomics_directory_scan(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "rad")
    os.makedirs(d)
    _write(os.path.join(d, "ax t1_radiomics_train.csv"), "case_id,sex,age,rad_a,rad_b\n1,F,3,0.5,1\n2.0,M,4,x,2\nq,F,1,1,1\n", bom=True)
    _write(os.path.join(d, "ax t2_radiomics_train.csv"), "case_id,modality,rad_a\n2,t2,7\n3,t2,8\n")
    _write(os.path.join(d, "nokey_radiomics_train.csv"), "id,rad_a\n1,1\n")
    _write(os.path.join(d, "nofeat_radiomics_train.csv"), "case_id,age\n1,1\n")
    _write(os.path.join(d, "other_radiomics_val.csv"), "case_id,rad_a\n1,1\n")
    assert [m for m, _ in FS.list_modality_files(spark, d, "train")] == ["ax t1", "ax t2", "nofeat", "nokey"]
    df = FS.read_radiomics_split(spark, d, "train")
    assert set(df.columns) == {"case_id", "ax t1__rad_a", "ax t1__rad_b", "ax t2__rad_a"}
    rows = {r["case_id"]: r.asDict() for r in df.collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[2]["ax t1__rad_a"] is None and rows[2]["ax t2__rad_a"] == 7.0
    assert rows[3]["ax t1__rad_b"] is None
    assert FS.read_radiomics_split(spark, os.path.join(tmpdir_path, "missing"), "train") is None


def test_drop_exact_is_case_sensitive(spark):
    df = spark.createDataFrame([(1, "f", "F", 3)], "case_id int, sex string, x string, age int")
    df = df.select("case_id", "sex", F.col("x").alias("Sex"), "age")
    out = P.drop_exact(df, ["Sex", "age", "absent"])
    assert out.columns == ["case_id", "sex"] and out.first()["sex"] == "f"
    assert P.drop_exact(df, ["nothing"]).columns == df.columns


def test_align_union(spark):
    tr = spark.createDataFrame([(1, 1.0, 2.0)], "case_id int, a double, b double")
    va = spark.createDataFrame([(2, 3.0, "z")], "case_id int, a double, extra string")
    out = P.align_union({"train": tr, "val": va})
    assert out.columns == ["case_id", "a", "b", "split"]
    rows = {r["case_id"]: r for r in out.collect()}
    assert rows[2]["b"] is None and rows[2]["split"] == "val"


def test_submission_csv_sink(spark, tmpdir_path):
    df = spark.createDataFrame([(5, "G"), (6, "M")], "case_id bigint, pred string")
    out = os.path.join(tmpdir_path, "sub")
    FS.write_csv(FS.submission(df), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["case_id", "Overall_class"]
    assert sorted(tuple(r) for r in back.collect()) == [("5", "G"), ("6", "M")]
