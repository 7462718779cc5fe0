import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    builder = (SparkSession.builder.master("local[4]")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        d = tempfile.mkdtemp(prefix="sensorium-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture()
def scratch(spark):
    from sensorium.session import scratch_path
    return scratch_path(spark, "test")
