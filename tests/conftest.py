import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    """A plain session: everything must run on one that this library did not build."""
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]").appName("tests").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g")
         .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())  # else every Column looks up its call site
    s.sparkContext.setLogLevel("ERROR")
    yield s
    from lakeviews.session import clear_scratch

    clear_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
