import os

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("TZ", "UTC")
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def other_splits(spark):
    """Lets a test change how scans are split, as executors do that come and go."""
    keys = ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k, None) for k in keys}

    def split(n):
        spark.conf.set("spark.sql.files.openCostInBytes", "64")
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", n)

    yield split
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
