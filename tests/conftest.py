import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0 = "/root/testdata/sf0.001"
SF1 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ck = tempfile.mkdtemp(prefix="tabtext-test-ckpt-", dir="/tmp")
    s = (SparkSession.builder.master("local[4]").appName("tabtext-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", ck)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from tabtext.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tabtext-test-", dir="/tmp")
