import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = configure(SparkSession.builder.master("local[8]").appName("tests"))
    session = (
        builder.config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "legacy"])
def either_ansi(request, spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture
def column(spark):
    """Evaluate an expression of column ``v`` for a list of values."""

    def evaluate(values, expression, type_name="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {type_name}")
        return [r[0] for r in df.orderBy("i").select(expression).collect()]

    return evaluate
