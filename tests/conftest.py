import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from postwave.session import build_session  # noqa: E402

SAMPLES = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "postwave-tests", shuffle_partitions=4, driver_memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def samples():
    return SAMPLES


@pytest.fixture
def value(spark):
    """Evaluate a Column function on one string."""

    def run(function, text):
        return spark.createDataFrame([(text,)], "text string").select(function("text").alias("v")).first().v

    return lambda function, text: run(lambda c: function(spark_col(c)), text)


def spark_col(name):
    from pyspark.sql import functions as F

    return F.col(name)
