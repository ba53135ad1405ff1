import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = os.path.join(os.sep, "root", "testdata", "sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from glossa.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[4]").appName("glossa-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # A folder of its own below the configured one: nothing that an earlier run has saved is found.
    s.sparkContext.setCheckpointDir(f"{ensure_checkpoint_dir(s)}/tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
