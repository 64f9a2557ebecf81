"""Lines that do not fit, stores that change as a whole, and snapshots whose columns differ."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.plans import labels, pipeline
from ledgerloom.sources import evolution, folders, tables
from ledgerloom.sources.store import SnapshotStore, changed_days, content_digests
from tests.test_plans import LOANS, loan_line, rows

D = dt.date


# CSV lines that do not fit the header


def test_misfits_go_to_the_rejects(spark, tmp_path):
    source, bronze = tmp_path / "in", str(tmp_path / "bronze")
    source.mkdir()
    good = ["1,2,3", '"a,b",c,"d"', ",,", '7,"",9']
    bad = ["1,2", "1,2,3,4", '"a,b",2', '"a,b",1,2,"c,d"', "8"]
    (source / "a.csv").write_text("\n".join(["x,y,z", *good, *bad]) + "\n")
    (source / "b.csv").write_text("x,y\n1,2\n")
    tables.ingest(spark, str(source), bronze, {"a.csv": "a", "b.csv": "b"})
    assert rows(tables.read_parquet(spark, f"{bronze}/a")) == sorted(
        [("1", "2", "3"), ("a,b", "c", "d"), (None, None, None), ("7", None, "9")], key=repr
    )
    assert rows(tables.read_rejects(spark, bronze, "a")) == sorted(
        [
            ("1,2", "1", 2, 3, tables.TOO_FEW),
            ("1,2,3,4", "1", 4, 3, tables.TOO_MANY),
            ('"a,b",2', "a,b", 2, 3, tables.TOO_FEW),
            ('"a,b",1,2,"c,d"', "a,b", 4, 3, tables.TOO_MANY),
            ("8", "8", 1, 3, tables.TOO_FEW),
        ],
        key=repr,
    )
    assert rows(tables.read_rejects(spark, bronze, "b")) == [] and not folders.exists(spark, f"{bronze}_rejects/b")
    # once the file is mended there are no rejects any more
    (source / "a.csv").write_text("\n".join(["x,y,z", *good]) + "\n")
    tables.ingest(spark, str(source), bronze, {"a.csv": "a"})
    assert rows(tables.read_rejects(spark, bronze, "a")) == []
    assert tables.read_parquet(spark, f"{bronze}/a").count() == 4


def test_misfits_can_stay(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1\n1,2,3\n4,5\n")
    tables.ingest(spark, str(tmp_path), str(tmp_path / "bronze"), {"a.csv": "a"}, misfit=tables.PAD)
    assert rows(tables.read_parquet(spark, str(tmp_path / "bronze/a"))) == [("1", "2"), ("1", None), ("4", "5")]
    with pytest.raises(ValueError):
        tables.ingest(spark, str(tmp_path), str(tmp_path / "bronze"), {"a.csv": "a"}, misfit="guess")


def test_files_with_other_headers_are_errors(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,3\n")
    with pytest.raises(Exception):
        tables.read_csv_checked(spark, str(tmp_path)).collect()


# A store that changes as a whole


def snapshots(spark, *data):
    return spark.createDataFrame(list(data), "v string, snapshot_date date")


JAN, FEB, MAR = D(2023, 1, 1), D(2023, 2, 1), D(2023, 3, 1)
DAYS = [str(d) for d in (JAN, FEB, MAR)]


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


SCHEMA = "v string, snapshot_date date"


def test_a_write_replaces_its_days(spark, store):
    assert not store.exists() and rows(store.read(SCHEMA)) == []
    store.write(snapshots(spark, ("a", JAN), ("b", FEB), ("c", FEB)), DAYS)
    assert {d: s.rows for d, s in store.snapshots().items()} == {DAYS[0]: 1, DAYS[1]: 2}
    store.write(snapshots(spark, ("d", FEB)), DAYS[1:])
    assert rows(store.read(SCHEMA)) == [("a", JAN), ("d", FEB)]
    assert rows(store.read(SCHEMA, [FEB])) == [("d", FEB)]
    store.write(snapshots(spark), DAYS[:1])
    assert rows(store.read(SCHEMA)) == [("d", FEB)]


def test_a_day_is_read_without_the_others(spark, store):
    store.write(snapshots(spark, ("a", JAN), ("b", FEB)), DAYS)
    files = store.read(SCHEMA, [FEB]).inputFiles()
    assert files and all("snapshot_date=2023-02-01" in f for f in files)


def test_readers_of_the_version_before_go_on(spark, store):
    store.write(snapshots(spark, ("a", JAN)), DAYS)
    reader = store.read(SCHEMA)
    store.write(snapshots(spark, ("b", JAN)), DAYS)
    assert rows(reader) == [("a", JAN)] and rows(store.read(SCHEMA)) == [("b", JAN)]
    for v in "cde":
        store.write(snapshots(spark, (v, JAN)), DAYS)
    assert rows(store.read(SCHEMA)) == [("e", JAN)]
    assert len(folders.subfolders(spark, f"{store.path}/snapshot_date=2023-01-01")) == 2
    assert len(folders.files(spark, f"{store.path}/_manifest")) == 2


def test_a_failed_write_leaves_the_store_whole(spark, store):
    store.write(snapshots(spark, ("a", JAN), ("b", FEB)), DAYS)
    before = rows(store.read(SCHEMA))
    broken = snapshots(spark, ("x", JAN), ("stop", FEB)).repartition(2, "v").withColumn(
        "v", F.when(F.col("v") == "stop", F.raise_error(F.lit("broken"))).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="broken"):
        store.write(broken, DAYS)
    assert rows(store.read(SCHEMA)) == before


def test_staged_rows_are_not_seen_until_they_are_committed(spark, store):
    store.write(snapshots(spark, ("a", JAN)), DAYS)
    staged = store.stage(snapshots(spark, ("b", JAN), ("c", MAR)), DAYS)
    assert rows(store.read(SCHEMA)) == [("a", JAN)]
    assert rows(store.read_staged(staged)) == [("b", JAN), ("c", MAR)]
    store.commit(staged)
    assert rows(store.read(SCHEMA)) == [("b", JAN), ("c", MAR)]


def test_what_failed_writes_leave_is_pruned(spark, store):
    store.write(snapshots(spark, ("a", JAN)), DAYS)
    store.stage(snapshots(spark, ("b", JAN), ("c", MAR)), DAYS)
    report = rows(store.prune())
    assert report == [("snapshot_date=2023-01-01", 1, "kept"), ("snapshot_date=2023-03-01", 0, "deleted")]
    assert folders.subfolders(spark, store.path) == ["snapshot_date=2023-01-01"]
    assert rows(store.read(SCHEMA)) == [("a", JAN)]


def test_two_writers_cannot_swap_the_same_manifest(spark, store, monkeypatch):
    store.write(snapshots(spark, ("a", JAN)), DAYS)
    number = store._numbers()[-1]
    with pytest.raises(FileExistsError):
        store._swap(number, {})
    assert rows(store.read(SCHEMA)) == [("a", JAN)]


def test_digests_follow_the_content_only(spark):
    data = [("a", JAN), ("b", JAN), ("b", JAN), (None, FEB), ("c", None)]
    one = content_digests(snapshots(spark, *data))
    assert set(one) == {DAYS[0], DAYS[1]}
    assert content_digests(snapshots(spark, *reversed(data)).repartition(3)) == one
    fewer = content_digests(snapshots(spark, *data[1:]))
    assert fewer[DAYS[0]] != one[DAYS[0]] and fewer[DAYS[1]] == one[DAYS[1]]
    pair = "u string, v string, snapshot_date date"
    left, right = (spark.createDataFrame([(*x, JAN)], pair) for x in (("a", None), (None, "a")))
    assert content_digests(left) != content_digests(right)


def test_changed_days(spark, store):
    store.write(snapshots(spark, ("a", JAN)), DAYS, made_of={DAYS[0]: "1", DAYS[1]: "2"})
    assert changed_days(store, {DAYS[0]: "1", DAYS[1]: "2"}, DAYS) == []
    assert changed_days(store, {DAYS[0]: "1", DAYS[1]: "3", DAYS[2]: "4"}, DAYS) == DAYS[1:]
    assert changed_days(store, {DAYS[0]: "1"}, DAYS) == [DAYS[1]]


# The label store on top of it


@pytest.fixture
def loans(tmp_path):
    path = tmp_path / "lms_loan_daily.csv"

    def write(*lines):
        path.write_text("\n".join([LOANS, *lines]) + "\n")
        return str(path)

    return write


def writes(spark, root, layer):
    found = SnapshotStore(spark, f"{root}/{layer}").snapshots()
    return {d: s.write for d, s in found.items()}


LAYERS = ("bronze/lms", "silver/lms", "gold/label_store")


def test_only_changed_months_are_made_again(spark, loans, tmp_path):
    root, months = str(tmp_path / "mart"), ["2023-07-01", "2023-08-01", "2023-09-01"]
    lines = [loan_line("A_1", months[0], 6), loan_line("B_1", months[1], 6), loan_line("C_1", months[2], 5)]
    labels.build_label_store(spark, loans(*lines), root, months)
    first = {layer: writes(spark, root, layer) for layer in LAYERS}
    labels.build_label_store(spark, loans(*reversed(lines)), root, months)
    assert {layer: writes(spark, root, layer) for layer in LAYERS} == first
    lines[1] = loan_line("B_1", months[1], 6, overdue="100.0")
    changed = rows(labels.build_label_store(spark, loans(*lines), root, months))
    for layer in LAYERS:
        now = writes(spark, root, layer)
        assert [m for m in months if now.get(m) != first[layer].get(m)] == [months[1]]
    assert changed == rows(labels.build_label_store(spark, loans(*lines), str(tmp_path / "full"), months))
    other = labels.build_label_store(spark, loans(*lines), root, months, mob=5)
    assert [r[0] for r in rows(other)] == ["C_1"]


def test_a_failed_back_fill_leaves_all_layers_whole(spark, loans, tmp_path, monkeypatch):
    root, months = str(tmp_path / "mart"), ["2023-07-01", "2023-08-01"]
    store = labels.build_label_store(spark, loans(loan_line("A_1", months[0], 6), loan_line("B_1", months[1], 6)), root, months)
    before, first = rows(store), {layer: writes(spark, root, layer) for layer in LAYERS}

    def breaking(silver, dpd, mob, gold=labels.label_gold):
        stop = F.when(F.col(fv.SNAPSHOT) == F.lit(months[1]).cast("date"), F.raise_error(F.lit("broken")))
        return gold(silver, dpd, mob).withColumn("label", stop.otherwise(F.col("label")).cast("int"))

    monkeypatch.setattr(labels, "label_gold", breaking)
    with pytest.raises(Exception, match="broken"):
        labels.build_label_store(spark, loans(loan_line("C_1", months[0], 6), loan_line("D_1", months[1], 6)), root, months)
    assert rows(labels.read_label_store(spark, root)) == before
    assert {layer: writes(spark, root, layer) for layer in LAYERS} == first
    monkeypatch.undo()
    again = labels.build_label_store(spark, loans(loan_line("C_1", months[0], 6), loan_line("D_1", months[1], 6)), root, months)
    assert [r[0] for r in rows(again)] == ["C_1", "D_1"]


def test_plain_snapshot_folders_are_read_and_pruned_as_well(spark, tmp_path):
    store = spark.createDataFrame([("L", "C", 1, "d", JAN)], labels.LABEL_SCHEMA)
    tables.overwrite_snapshots(store, str(tmp_path / "gold/label_store"))
    assert labels.read_label_store(spark, str(tmp_path)).count() == 1
    assert rows(labels.prune_label_store(spark, str(tmp_path))) == [("snapshot_date=2023-01-01", 1, "kept")]


# Snapshots whose columns differ


@pytest.mark.parametrize(
    "a, b, expected",
    [
        ("int", "int", "int"),
        ("tinyint", "bigint", "bigint"),
        ("smallint", "float", "float"),
        ("int", "float", "double"),
        ("int", "double", "double"),
        ("bigint", "double", "string"),
        ("float", "double", "double"),
        ("int", "string", "string"),
        ("date", "string", "string"),
        ("decimal(5,2)", "decimal(9,1)", "decimal(10,2)"),
        ("decimal(5,2)", "int", "decimal(12,2)"),
        ("decimal(38,2)", "bigint", "decimal(38,2)"),
        ("decimal(38,20)", "bigint", "string"),
        ("boolean", "int", "string"),
    ],
)
def test_wider_types(spark, a, b, expected):
    one, two = (spark.createDataFrame([], f"x {t}").schema["x"].dataType for t in (a, b))
    assert evolution.wider(one, two).simpleString() == evolution.wider(two, one).simpleString() == expected


def test_snapshots_with_other_columns(spark, store):
    write = lambda data, schema, day: store.write(spark.createDataFrame(data, f"{schema}, snapshot_date date"), [day])
    write([("1", "x", JAN), ("ten", None, JAN)], "n string, gone string", JAN)
    write([(2, FEB)], "n int", FEB)
    write([(3, 0.5, MAR), (None, None, MAR)], "n bigint, `new one` double", MAR)
    merged = evolution.read_merged(store)
    assert merged.dtypes == [("n", "string"), ("gone", "string"), ("new one", "double"), ("snapshot_date", "date")]
    assert rows(merged) == sorted(
        [
            ("1", "x", None, JAN),
            ("ten", None, None, JAN),
            ("2", None, None, FEB),
            ("3", None, 0.5, MAR),
            (None, None, None, MAR),
        ],
        key=repr,
    )
    report = rows(evolution.schema_report(store, {"n": "int", "extra": "date"}))
    assert report == sorted(
        [
            (JAN, "n", "same", "string", "string", "int", 1),
            (JAN, "gone", "same", "string", "string", None, 0),
            (JAN, "new one", "missing", None, "double", None, 0),
            (JAN, "extra", "missing", None, None, "date", 0),
            (FEB, "n", "widened", "int", "string", "int", 0),
            (FEB, "gone", "missing", None, "string", None, 0),
            (FEB, "new one", "missing", None, "double", None, 0),
            (FEB, "extra", "missing", None, None, "date", 0),
            (MAR, "n", "widened", "bigint", "string", "int", 0),
            (MAR, "gone", "missing", None, "string", None, 0),
            (MAR, "new one", "added", "double", "double", None, 0),
            (MAR, "extra", "missing", None, None, "date", 0),
        ],
        key=repr,
    )


def test_a_store_without_snapshots_has_no_columns(store):
    assert evolution.read_merged(store).columns == [fv.SNAPSHOT]
    assert rows(evolution.schema_report(store)) == []


def test_each_schema_is_scanned_once(spark, store):
    for day, schema in ((JAN, "a int"), (FEB, "a int"), (MAR, "a bigint")):
        store.write(spark.createDataFrame([(1, day)], f"{schema}, snapshot_date date"), [day])
    plan = evolution.read_merged(store)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
