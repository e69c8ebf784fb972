import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from sortproof.session import DEFAULT_CONF

    b = SparkSession.builder.master("local[4]").appName("sortproof-tests")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "8")
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder (the setting is unset here)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sortproof-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def records_df(spark):
    def make(rows):
        from sortproof.schema import RECORD_SCHEMA

        return spark.createDataFrame(rows, RECORD_SCHEMA)

    return make
