"""The registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.catalog.adapters import RAW_TABLES
from ledgerloom.catalog.oracle import all_sql
from ledgerloom.catalog.queries import all_queries
from tools.check_queries import TABLES, rows

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_equals_sql(spark, con, name):
    """No result is empty either, so a query that finds nothing would be seen."""
    frame = QUERIES[name](spark, SF_DIR)
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    found = frame.collect()
    assert found
    assert rows(frame.columns, found) == rows(columns, result.fetchall())


@pytest.mark.parametrize("name", ["training_exact", "training_as_of", "full_run", "full_run_as_of"])
def test_labels_meet_every_table(spark, name):
    """At least a twentieth of the labels have a row of each feature table."""
    table = QUERIES[name](spark, SF_DIR).cache()
    for dataset in RAW_TABLES:
        met = table.filter(F.col(f"{dataset}_snapshot_date").isNotNull()).count()
        assert met * 20 >= table.count(), dataset


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_queries_limit_generated_methods(spark):
    """A session that was built without ``configure`` compiles wide projections too, once a query has been made in it."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "65535")
        entry.queries()["fin_caps"](spark, SF_DIR)
        assert spark.conf.get(name) == "8000"
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("name", ["gold_click", "gold_fin"])
def test_gold_tables_cast_raw_text_once(spark, name):
    """Silver that is read twice is stored first, so neither read goes back to the raw table."""
    files = entry.queries()[name](spark, SF_DIR).inputFiles()
    assert files and not any("events" in f or "orders" in f for f in files)
