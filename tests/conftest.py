import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from logroll.session import configure

    ckpt = tempfile.mkdtemp(prefix="logroll-test-")
    s = (SparkSession.builder.master("local[*]").appName("logroll-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", ckpt)
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="logroll-wh-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from logroll.session import scratch_dir
    return lambda name="t": scratch_dir(spark, name)
