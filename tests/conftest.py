from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def make_session(cores: str = "8", partitions: str = "8"):
    from pyspark.sql import SparkSession

    from opsfold.config import configure, ensure_checkpoint_dir

    spark = (SparkSession.builder.master(f"local[{cores}]")
             .appName("opsfold-tests")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", partitions)
             .config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="opsfold-ckpt-"))
    return spark


@pytest.fixture(scope="session")
def spark():
    s = make_session()
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="opsfold-test-")
