import pathlib

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("strata-tests")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.sql.streaming.pollingDelay", "1ms")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        # Compiling code costs more than running it on a handful of rows.
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def load_file(spark):
    """A JSON document or CSV file with header as a frame."""
    readers = {
        ".json": lambda p: spark.read.json(p, multiLine=True),
        ".csv": lambda p: spark.read.csv(p, header=True),
    }
    return lambda path: readers[pathlib.Path(path).suffix](str(path))


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, columns in name order."""

    def collect(df):
        names = sorted(df.columns)
        return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)

    return collect
