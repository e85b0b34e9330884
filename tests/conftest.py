import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rillweave.session import configured  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
    )
    session = configured(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of an expression over a text column ``x``, in input order."""

    def run(expression, values, schema="i int, x string"):
        frame = spark.createDataFrame(list(enumerate(values)), schema).repartition(2)
        rows = frame.selectExpr("i", f"{expression} AS y").collect()
        return [r.y for r in sorted(rows, key=lambda r: r.i)]

    return run
