import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = (SparkSession.builder.master("local[*]")
               .appName("streamkit-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="streamkit-warehouse-"))
               .config("spark.ui.enabled", "false"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if s.sparkContext.getConf().get("spark.checkpoint.dir", None) is None and \
            s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="streamkit-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
