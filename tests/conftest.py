from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Value of a column function on each of the given values."""

    def run(function, values, kind="string"):
        from pyspark.sql import functions as F

        rows = [(place, value) for place, value in enumerate(values)]
        df = spark.createDataFrame(rows, f"place int, value {kind}").repartition(2)
        result = df.select("place", function(F.col("value")).alias("result")).collect()
        return [row["result"] for row in sorted(result, key=lambda row: row["place"])]

    return run
