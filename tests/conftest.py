import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[8]").appName("apportia-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, nulls first."""

    def collect(df, *cols):
        found = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in found.collect()), key=lambda t: [(v is not None, str(v)) for v in t])

    return collect
