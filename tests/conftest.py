import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    from catalink.sources.tables import clear_staged

    clear_staged(s)
    s.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Makes a DataFrame of rows and a schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows_of(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
