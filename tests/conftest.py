import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from skillstream.session import build_session
    extra = {}
    from pyspark.sql import SparkSession
    s = build_session("local[4]", app_name="skillstream-tests", shuffle_partitions=8, extra=extra)
    # tests own their checkpoint folder only where the environment sets none
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="skillstream-test-ck-")
        s.sparkContext.setCheckpointDir(d)
        s.conf.set("spark.checkpoint.dir", d)
    yield s


@pytest.fixture()
def scratch(spark):
    from skillstream.session import scratch_path
    return lambda name: scratch_path(spark, name)
