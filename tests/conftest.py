import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from loadkit import configure

    session = (
        SparkSession.builder.master("local[4]")
        .appName("loadkit-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="loadkit-ckpt-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture
def texts(spark):
    """Frame of text values in order."""

    def make(values, name="x"):
        rows = [(i, v) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, f"i int, {name} string")

    return make


@pytest.fixture
def column(texts):
    """Values of a column function over a list of texts."""

    def run(function, values):
        frame = texts(values).select("i", function("x").alias("y"))
        return [r.y for r in sorted(frame.collect(), key=lambda r: r.i)]

    return run
