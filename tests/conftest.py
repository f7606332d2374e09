import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from cinerank.schema import RATINGS_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]")
         .appName("cinerank-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cinerank-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def ratings(spark):
    def make(rows, schema=RATINGS_SCHEMA):
        return spark.createDataFrame(rows, schema)
    return make


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="cinerank-test-")
