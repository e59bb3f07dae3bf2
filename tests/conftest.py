import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    ckpt = tmp_path_factory.mktemp("ckpt")
    s = (SparkSession.builder.master("local[4]").appName("veriscope-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", str(ckpt))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from veriscope.session import ship_package
    ship_package(s)
    yield s
    s.stop()


@pytest.fixture
def out_dir(tmp_path):
    return str(tmp_path)
