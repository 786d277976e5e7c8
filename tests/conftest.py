import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def pytest_collection_modifyitems(items):
    """First the test that counts executions, as a session keeps no more than 1,000 of them."""
    items.sort(key=lambda item: item.name != "test_any_depth_takes_one_aggregation")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.sql.maxMetadataStringLength", "100000")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """The rows of a frame as a sorted list of tuples, for comparing without order."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect


@pytest.fixture
def plan():
    """The physical plan's text: before running, or with ``final=True`` after."""

    def text(df, final=False):
        if final:
            df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
