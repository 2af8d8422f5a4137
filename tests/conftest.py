import pytest
from pyspark.sql import SparkSession

from leafmill.session import share_code


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield share_code(session)
    session.stop()


def rows(df):
    """The rows of a DataFrame as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
