"""A JSON object read by ranges, with borders at every place."""

import itertools
import json
import os

import pyarrow as pa
import pytest

from tabtext.sources import cases as C
from tabtext.sources import jsonsplit as J

RECORDS = {"1": {"report": "a, b", "x": [1, {"y": "}, {"}, []]}, "22": {"report": "quote \" and \\", "z": "\\\\\","}, "3": {}, "é": "ü,{[\"",
           "5": {"report": {"finding": "[,]"}}, "6": [], "7": None, "8": ",,,", "9": "\\"}


def read_ranges(pieces, cuts, batch):
    """The two passes and the joining of what touches borders, over given ranges of pieces."""
    ranges = [pieces[a:z] for a, z in itertools.pairwise([0, *cuts, len(pieces)]) if z > a]
    batches = [pa.RecordBatch.from_pydict({"file": ["f"] * len(p), "start": pa.array([s] * len(p), pa.int64()), "value": p})
               for s, r in enumerate(ranges) for p in (r[i:i + batch] for i in range(0, len(r), batch))]
    rows = [r for b in J._summary(iter(batches)) for r in b.to_pylist()]
    cut = [r for b in J._cut(J._states(rows))(iter(batches)) for r in b.to_pylist()]
    out, owner = {}, None
    for r in sorted(cut, key=lambda r: (r["start"], r["idx"])):
        if r["idx"] > 0:
            owner = (r["start"], r["idx"])
        if owner:
            out[owner] = out.get(owner, "") + r["text"]
    return [e for e in out.values() if e.strip(" \n,")]


@pytest.mark.parametrize("style", [{}, {"indent": 1}, {"separators": (",", ":"), "ensure_ascii": False}])
def test_every_border(style):
    pieces = (json.dumps(RECORDS, **style) + "\n").split(",")
    for k in (0, 1, 2):
        for cuts in itertools.combinations(range(1, len(pieces)), k):
            for batch in (1, 1000):
                got = [json.loads("{" + e.rstrip(" \n,") + "}") for e in read_ranges(pieces, cuts, batch)]
                assert sum(map(len, got)) == len(RECORDS) and {k: v for g in got for k, v in g.items()} == RECORDS


@pytest.fixture
def small_ranges(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]

    def to(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "1")

    yield to
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [13, 60])
def test_ranges_of_a_file(spark, tmpdir_path, small_ranges, size):
    path = os.path.join(tmpdir_path, "case.json")
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(RECORDS) + "\n")
    small_ranges(size)
    got = {}
    for r in J.read_entries(spark, path).collect():
        got |= json.loads("{" + r.entry.rstrip(" \n,") + "}")
    assert got == RECORDS and J._pieces(spark, path).rdd.getNumPartitions() > 3


def test_several_files(spark, tmpdir_path, small_ranges):
    small_ranges(2000)
    for k in range(2):
        with open(os.path.join(tmpdir_path, f"{k}.json"), "w") as f:
            json.dump({str(100 * k + i): {"report": f"text {i}, more \"{k}\"", "available_modalities": ["a"] * (i % 3), "Overall_class": "c"}
                       for i in range(60)}, f)
    with open(os.path.join(tmpdir_path, "none.json"), "w") as f:
        f.write("{ }")
    rows = C.read_case_json(spark, tmpdir_path).collect()
    assert sorted((r.case_id, r.report, r.n_modalities) for r in rows) == sorted(
        (100 * k + i, f"text {i}, more \"{k}\"", i % 3) for k in range(2) for i in range(60))
