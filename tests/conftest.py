import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("talkweave-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column_values(spark):
    """Apply a column function to texts and return the results in order."""
    from pyspark.sql import functions as F

    def apply(make, texts):
        frame = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
        rows = frame.select("i", make(F.col("x")).alias("y")).collect()
        return [r.y for r in sorted(rows, key=lambda r: r.i)]

    return apply
