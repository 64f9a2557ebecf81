"""Statistics merged from stored states equal those of the whole table, and only new snapshots are read."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.operators import state
from ledgerloom.operators.categories import category_counts
from ledgerloom.operators.statistics import clip_sigma, moments
from ledgerloom.sources.store import SnapshotStore
from tests.test_plans import rows

D = dt.date
MONTHS = [D(2023, m, 1) for m in range(1, 5)]
SCHEMA = "a int, b double, snapshot_date date"


@pytest.fixture(scope="module")
def table(spark):
    # a small spread around a large mean, a snapshot with one row, one with nulls only, rows without a date
    data = [(1_000_000_000 + i % 7, i * 0.1, MONTHS[i % 2]) for i in range(200)]
    data += [(3, None, MONTHS[2]), *[(None, None, MONTHS[3])] * 4, (5, 2.5, None), (6, None, None)]
    return spark.createDataFrame(data, SCHEMA)


def close(one, other):
    assert one.asDict().keys() == other.asDict().keys()
    for name, value in one.asDict().items():
        assert value == other[name] or math.isclose(value, other[name], rel_tol=1e-12), name


def test_merged_moments_are_those_of_the_whole(table):
    found = state.merged_moments(state.moment_state(table, ["a", "b"]), ["a", "b"]).select("stats.*").first()
    close(found, moments(table, ["a", "b"]).first())


def test_moments_of_few_rows(spark):
    for data in ([], [(None, None, MONTHS[0])], [(1, None, MONTHS[0])], [(1, 2.0, MONTHS[0]), (4, None, MONTHS[1])]):
        df = spark.createDataFrame(data, SCHEMA)
        found = state.merged_moments(state.moment_state(df, ["a", "b"]), ["a", "b"]).select("stats.*").first()
        close(found, moments(df, ["a", "b"]).first())


def test_a_changed_snapshot_replaces_its_state_only(spark, table, tmp_path):
    path = str(tmp_path / "state")
    for part in (table.filter(F.col(fv.SNAPSHOT).isNull()), *[table.filter(F.col(fv.SNAPSHOT) == m) for m in MONTHS]):
        state.write_state(state.moment_state(part, ["a", "b"]), path)
    names = {p.name for p in (tmp_path / "state").iterdir() if p.is_dir()}
    assert names == {"state_of=undated", *[f"state_of={m}" for m in MONTHS]}
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "state").rglob("*.parquet")}
    now = table.withColumn("a", F.when(F.col(fv.SNAPSHOT) == MONTHS[2], 77).otherwise(F.col("a")))
    state.write_state(state.moment_state(now.filter(F.col(fv.SNAPSHOT) == MONTHS[2]), ["a", "b"]), path)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "state").rglob("*.parquet")}
    changed = {p.parent.name for p in after if before.get(p) != after[p]}
    assert changed == {f"state_of={MONTHS[2]}"}
    stored = state.read_state(spark, path, state.moment_state(table, ["a", "b"]))
    close(state.merged_moments(stored, ["a", "b"]).select("stats.*").first(), moments(now, ["a", "b"]).first())


def test_gold_of_a_month_reads_that_month_and_the_state(spark, table, tmp_path):
    store, path = SnapshotStore(spark, str(tmp_path / "silver")), str(tmp_path / "state")
    dated = table.dropna(subset=[fv.SNAPSHOT])
    store.write(dated, MONTHS)
    state.write_state(state.moment_state(dated, ["a", "b"]), path)
    stats = state.merged_moments(state.read_state(spark, path, state.moment_state(dated, ["a", "b"])), ["a", "b"])
    month = store.read(SCHEMA, [MONTHS[1]])
    made = clip_sigma(month, ["a", "b"], 1, stats)
    read = [f for f in made.inputFiles() if str(tmp_path / "silver") in f]
    assert read and all(f"snapshot_date={MONTHS[1]}" in f for f in read)
    key = lambda r: repr(tuple(r)[2:])
    whole = clip_sigma(dated, ["a", "b"], 1).filter(F.col(fv.SNAPSHOT) == MONTHS[1])
    for one, other in zip(sorted(made.collect(), key=key), sorted(whole.collect(), key=key), strict=True):
        close(one, other)


def test_merged_categories_are_those_of_the_whole(spark, tmp_path):
    data = [(f"c{i % 3}" if i % 5 else None, i, MONTHS[i % 3] if i % 4 else None) for i in range(60)]
    df = spark.createDataFrame(data, "kind string, x int, snapshot_date date")
    path = str(tmp_path / "state")
    state.write_state(state.category_state(df, "kind", ["x"]), path)
    stored = state.read_state(spark, path, state.category_state(df, "kind", ["x"]))
    whole = category_counts(df, "kind", ["x"])
    merged = state.merged_categories(stored, "kind")
    assert merged.columns == whole.columns and rows(merged) == rows(whole)
