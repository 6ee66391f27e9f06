import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
SF_LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from clickweir.session import shared_dir

    s = (
        SparkSession.builder.master("local[*]")
        .appName("clickweir-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)  # sets a local checkpoint folder only when none is configured
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from oracle_compare import duck

    return duck(SF_SMALL)
