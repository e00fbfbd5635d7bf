import tempfile

import pytest
from pyspark.sql import SparkSession

from tablewright.session import tune


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield tune(session)
    session.stop()


@pytest.fixture
def many_partitions(spark):
    """Keep small shuffles in many partitions, so that blocks really are several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
