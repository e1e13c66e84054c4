import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from urbanpulse.session import RUNTIME_CONF
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    builder = (SparkSession.builder.master("local[4]").appName("urbanpulse-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", scratch))
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(scratch)
    yield session
    session.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
