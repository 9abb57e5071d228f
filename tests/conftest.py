import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("layerkit-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from layerkit.session import checkpoint_root

    checkpoint_root(s)  # sets a scratch checkpoint dir only when the session has none
    yield s


@pytest.fixture
def scratch(spark):
    from layerkit.session import run_dir

    return run_dir(spark, "test")
