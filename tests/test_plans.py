import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.catalog.adapters import RAW_TABLES
from ledgerloom.plans import gold, labels, pipeline, silver, training
from ledgerloom.sources import folders, tables

D = dt.date
LOANS = "loan_id,Customer_ID,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,overdue_amt,balance,snapshot_date"
FIN_COLUMNS = (
    fv.CUSTOMER,
    *fv.FINANCIAL_AMOUNTS,
    *fv.FINANCIAL_COUNTS,
    "Credit_Mix",
    "Payment_Behaviour",
    "Type_of_Loan",
    "Credit_History_Age",
    "Payment_of_Min_Amount",
    fv.SNAPSHOT,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def loan_line(loan, day, mob, due="100.0", overdue="0.0"):
    return f"{loan},{loan.split('_')[0]},2023-01-01,10,{mob},1000,{due},100.0,{overdue},500.0,{day}"


def fin_row(customer, day, **changed):
    row = {c: "10" for c in FIN_COLUMNS}
    row |= {"Credit_Mix": "Good", "Payment_Behaviour": "Low_spent", "Credit_History_Age": "1 Years and 1 Months"}
    row |= {fv.CUSTOMER: customer, fv.SNAPSHOT: day} | changed
    return tuple(row[c] for c in FIN_COLUMNS)


def financial_table(spark, data):
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in FIN_COLUMNS))


@pytest.fixture
def loan_csv(tmp_path):
    path = tmp_path / "lms_loan_daily.csv"

    def write(*lines):
        path.write_text("\n".join([LOANS, *lines]) + "\n")
        return str(path)

    return write


def test_label_silver_fills_numbers_only(either_ansi, loan_csv):
    raw = tables.read_csv_text(either_ansi, loan_csv("A_1,A,2023-01-01,,6,,,5.0,7.5,,2023-07-01"))
    row = labels.label_silver(raw).first()
    assert (row["tenure"], row["loan_amt"], row["due_amt"], row["installments_missed"]) == (0, 0.0, 0.0, 0)
    assert row["first_missed_date"] is None and row["dpd"] is None
    assert dict(labels.label_silver(raw).dtypes)["loan_amt"] == "float"


def test_missing_column_is_an_error(spark):
    with pytest.raises(Exception, match="overdue_amt"):
        labels.label_silver(spark.createDataFrame([("1",)], "loan_id string"))


def test_label_store_honours_its_parameters(spark, loan_csv, tmp_path):
    source = loan_csv(
        loan_line("A_1", "2023-07-01", 6, overdue="100.0"),
        loan_line("B_1", "2023-07-01", 6),
        loan_line("C_1", "2023-08-01", 6, overdue="300.0"),
        loan_line("D_1", "2023-08-01", 3, overdue="300.0"),
        loan_line("E_1", "2023-09-01", 6, overdue="300.0"),
    )
    dates, root = ["2023-07-01", "2023-08-01"], str(tmp_path / "mart")
    store = labels.build_label_store(spark, source, root, dates)
    assert rows(store) == [
        ("A_1", "A", 1, "30dpd_6mob", D(2023, 7, 1)),
        ("B_1", "B", 0, "30dpd_6mob", D(2023, 7, 1)),
        ("C_1", "C", 1, "30dpd_6mob", D(2023, 8, 1)),
    ]
    strict = labels.build_label_store(spark, source, str(tmp_path / "strict"), dates, dpd=60, mob=3)
    assert rows(strict) == [("D_1", "D", 1, "60dpd_3mob", D(2023, 8, 1))]


def test_a_rerun_replaces_only_its_snapshots(spark, loan_csv, tmp_path):
    root, dates = str(tmp_path / "mart"), ["2023-07-01", "2023-08-01"]
    first = loan_csv(loan_line("A_1", "2023-07-01", 6), loan_line("B_1", "2023-08-01", 6))
    before = rows(labels.build_label_store(spark, first, root, dates))
    assert rows(labels.build_label_store(spark, first, root, dates)) == before
    changed = loan_csv(loan_line("C_1", "2023-08-01", 6))
    again = labels.build_label_store(spark, changed, root, ["2023-08-01"])
    assert [r[0] for r in rows(again)] == ["A_1", "C_1"]
    emptied = labels.build_label_store(spark, loan_csv(loan_line("C_1", "2023-08-01", 5)), root, ["2023-08-01"])
    assert [r[0] for r in rows(emptied)] == ["A_1"]
    nothing = labels.build_label_store(spark, loan_csv(), str(tmp_path / "none"), dates)
    assert rows(nothing) == []


def test_bronze_step_alone(spark, loan_csv, tmp_path):
    source = loan_csv(loan_line("A_1", "2023-07-01", 6), loan_line("B_1", "2023-08-01", 6))
    stored = labels.write_bronze(spark, source, str(tmp_path / "mart"), ["2023-08-01"])
    assert [(r["loan_id"], r["due_amt"], r[fv.SNAPSHOT]) for r in stored.collect()] == [("B_1", "100.0", D(2023, 8, 1))]
    assert folders.subfolders(spark, str(tmp_path / "mart" / "bronze" / "lms")) == ["snapshot_date=2023-08-01"]


def test_a_large_snapshot_is_split_over_files(spark, tmp_path):
    df = spark.range(0, 400_000, 1, 8).selectExpr("uuid() AS v", "if(id % 10 = 0, DATE'2023-02-01', DATE'2023-01-01') AS snapshot_date")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1m")
    try:
        tables.overwrite_snapshots(df, str(tmp_path / "store"), gather=True)
    finally:
        spark.conf.set(size, before)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "store").iterdir() if p.is_dir()}
    assert files["snapshot_date=2023-01-01"] > 4 and files["snapshot_date=2023-02-01"] <= 2
    assert tables.read_snapshots(spark, str(tmp_path / "store")).count() == 400_000


def test_default_snapshot_dates(spark):
    dates = labels.snapshot_dates(spark)
    assert len(dates) == 24 and dates[0] == "2023-01-01" and dates[-1] == "2024-12-01"


def test_csv_text_keeps_column_names_with_their_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,\n")
    (tmp_path / "b.csv").write_text("y,x\n2,3\n")
    assert rows(tables.read_csv_text(spark, str(tmp_path / "a.csv"))) == [("1", None)]
    with pytest.raises(Exception):
        tables.read_csv_text(spark, str(tmp_path)).collect()


def test_prune_empty_folders(spark, tmp_path):
    store = tmp_path / "store"
    some = spark.createDataFrame([(1,), (2,)], "x int")
    some.write.parquet(str(store / "a+b 2023.parquet"))
    some.filter("false").write.parquet(str(store / "empty"))
    (store / "broken").mkdir()
    (store / "broken" / "part.parquet").write_text("no parquet")
    report = rows(folders.prune_empty_folders(spark, str(store)))
    assert report == [("a+b 2023.parquet", 2, "kept"), ("broken", None, "skipped"), ("empty", 0, "deleted")]
    assert sorted(p.name for p in store.iterdir()) == ["a+b 2023.parquet", "broken"]
    assert rows(folders.prune_empty_folders(spark, str(tmp_path / "none"))) == []


def test_financial_gold_order(spark):
    data = [
        fin_row("A", "2023-01-01", Annual_Income="3000000", Num_of_Loan="30", Monthly_Inhand_Salary="0.0"),
        fin_row("A", "2023-01-01", Annual_Income="4000000", Num_of_Loan="30", Monthly_Inhand_Salary="0.0"),
        fin_row("B", "2023-01-01", Num_of_Loan="3_", Credit_Mix="_", Payment_of_Min_Amount="NM"),
    ]
    out = gold.financials(silver.financials(financial_table(spark, data)), rare_below=2)
    got = {r[fv.CUSTOMER]: r for r in out.collect()}
    a, b = got["A"], got["B"]
    assert "Credit_History_Age" not in out.columns and len(got) == 2
    assert (a["Annual_Income"], a["annual_income_outlier_flag"], a["Num_of_Loan"]) == (2000000.0, 1, 20.0)
    assert a["emi_to_income_ratio"] is None and a["loan_per_card_ratio"] == 2.0
    # the mean is that of all three rows after capping, before duplicates go
    assert (b["Num_of_Loan"], b["num_of_loan_missing_flag"], b["loan_per_card_ratio"]) == (20.0, 1, None)
    assert (b["credit_mix_unknown_flag"], b["payment_min_not_measured_flag"]) == (1, 1)
    assert {a["Payment_Behaviour_grouped"], b["Payment_Behaviour_grouped"]} == {"low spent"}


def test_unknown_financial_columns_pass_through(spark):
    raw = financial_table(spark, [fin_row("A", "2023-01-01")]).withColumn("extra", F.lit("kept"))
    assert silver.financials(raw).first()["extra"] == "kept"


def label_rows(spark, data):
    return spark.createDataFrame(data, "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date")


@pytest.mark.parametrize("mode", [training.EXACT, training.AS_OF])
@pytest.mark.parametrize("hot", [False, True])
def test_training_table_against_brute_force(spark, monkeypatch, mode, hot):
    if hot:
        monkeypatch.setattr(training.left_join_unique, "__defaults__", (2,))
        monkeypatch.setattr(training.KeyCounts.fit_broadcast, "__defaults__", (0, 0))
    months = [D(2023, m, 1) for m in range(1, 13)]
    customers = [f"C{i}" for i in range(6)] + [None]
    data = [(f"L{i}", f" {c} " if c else c, 1, "d", months[(i * 5) % 12]) for i in range(12) for c in customers]
    data += [("L0", " C0 ", 1, "d", months[7])] * 20
    attrs = [(c, 20 + i, months[i]) for c in customers for i in (0, 2, 3, 7) if c != "C5"]
    attrs += [("C1", 99, months[2]), ("C1", None, months[3])]
    loans = [(f"L{i}", "C2", i * 1.0, months[m]) for i in range(8) for m in (i, 8)]
    features = {
        "attributes": spark.createDataFrame(attrs, "Customer_ID string, Age int, snapshot_date date"),
        "loan_daily": spark.createDataFrame(loans, "loan_id string, Customer_ID string, ratio double, snapshot_date date"),
    }
    got = training.training_table(label_rows(spark, data), features, mode, mob=2)

    def back(day):
        return D(day.year - (day.month < 3), (day.month - 3) % 12 + 1, 1)

    def match(table, key, day):
        target = day if mode == training.EXACT else back(day)
        found = [r for r in table if r[:-2] == key and (r[-1] == target if mode == training.EXACT else r[-1] <= target)]
        found = [r for r in found if r[-1] == max(f[-1] for f in found) and None not in key]
        best = min(found, key=lambda r: (r[-2] is not None, r[-2] or 0), default=(None, None))
        return best[-2], best[-1]

    expected = []
    for loan, customer, label, name, day in data:
        key = customer.strip() if customer else None
        age, age_day = match(attrs, (key,), day)
        ratio, ratio_day = match(loans, (loan, key), day)
        expected.append((loan, key, label, name, day, age, age_day, ratio, ratio_day))
    assert rows(got) == sorted(expected, key=repr)


def test_training_mode_is_checked(spark):
    with pytest.raises(ValueError):
        training.training_table(label_rows(spark, []), {}, "sideways")


def test_full_runs_only_what_is_on(spark, loan_csv, tmp_path):
    loan_csv(
        loan_line("A_1", "2023-07-01", 6, overdue="100.0"),
        loan_line("A_1", "2023-07-01", 6, overdue="100.0"),
        loan_line("B_1", "2023-08-01", 2),
    )
    root = str(tmp_path / "mart")
    files = {"lms_loan_daily.csv": "loan_daily"}
    tables.ingest(spark, str(tmp_path), f"{root}/bronze", files)
    assert pipeline.run(spark, str(tmp_path), root, {}) == {}
    assert not folders.exists(spark, f"{root}/silver")
    config = {
        "run_silver": True,
        "run_gold": True,
        "run_label": True,
        "run_label_cleanup": True,
        "run_join": True,
        "datasets": {"loan_daily": True, "clickstream": False},
        "label_store": {"dpd": 30, "mob": 6, "snapshot_dates": ["2023-07-01", "2023-08-01"]},
    }
    reports = pipeline.run(spark, str(tmp_path), root, config)
    assert rows(reports["silver/loan_daily/duplicates"]) == [(3, 2, 1)]
    assert rows(reports["label/store/labels"]) == [(D(2023, 7, 1), "30dpd_6mob", 2, 2)]
    assert [r[2] for r in rows(reports["label/store/cleanup"])] == ["kept"]
    assert not folders.exists(spark, f"{root}/gold/clickstream")
    table = tables.read_parquet(spark, f"{root}/gold/final_training_table")
    assert [r["payment_ratio"] for r in table.collect()] == [1.0, 1.0]
    for name, report in reports.items():
        report.collect()


def test_pipeline_error_is_not_swallowed(spark, tmp_path):
    with pytest.raises(Exception):
        pipeline.run(spark, str(tmp_path / "none"), str(tmp_path / "mart"), {"run_bronze": True})


def raw_rows(spark, name):
    """Untidy rows of a raw table, two of each kind."""
    columns = RAW_TABLES[name][1]
    values = ["1", "-2", "3.5", "4_", "x", "", None, "2023-01-01", "2023-04-01", "2023-06-15", " A "]
    data = [tuple(values[(i + k) % len(values)] for k in range(len(columns))) for i in range(len(values))] * 2
    data = [(*r[:-1], d) for r, d in zip(data, ["2023-01-01", "2023-04-01", "2023-07-20", "x", None] * 5, strict=False)]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))


@pytest.mark.parametrize("name", list(RAW_TABLES))
@pytest.mark.parametrize("empty", [False, True])
def test_reports_are_counted_while_silver_is_written(spark, tmp_path, name, empty):
    raw = raw_rows(spark, name).filter("false") if empty else raw_rows(spark, name).repartition(3)
    observed = silver.ObservedSilver(name)
    tables.overwrite_parquet(observed.clean(raw), str(tmp_path / "silver"))
    written = tables.read_parquet(spark, str(tmp_path / "silver"))
    scanned = {**silver.raw_reports(name, raw), **silver.silver_reports(name, written)}
    counted = observed.reports(spark)
    assert set(scanned) - set(counted) == {"invalid_samples", "duplicates"}
    for title, report in counted.items():
        assert report.dtypes == scanned[title].dtypes
        assert rows(report) == rows(scanned[title])
    assert empty or rows(counted["missing_months"]) == [(D(2023, m, 1),) for m in (2, 3, 5, 6, 7)]


def test_a_run_scans_a_table_for_samples_and_duplicates_only(spark, loan_csv, tmp_path):
    loan_csv(loan_line("A_1", "2023-07-01", 6))
    root = str(tmp_path / "mart")
    tables.ingest(spark, str(tmp_path), f"{root}/bronze", {"lms_loan_daily.csv": "loan_daily"})
    reports = pipeline.run(spark, str(tmp_path), root, {"run_silver": True, "datasets": {"loan_daily": True}})
    scanning = {n for n, r in reports.items() if "FileScan" in r._jdf.queryExecution().executedPlan().toString()}
    assert scanning == {"silver/loan_daily/invalid_samples", "silver/loan_daily/duplicates"}


def test_tables_without_rows(either_ansi, tmp_path):
    """Every cleaning, gold and label step, report and join takes tables without rows."""
    made = {}
    for name, (_, columns) in RAW_TABLES.items():
        raw = either_ansi.createDataFrame([], ", ".join(f"{c} string" for c in columns))
        clean = silver.TABLES[name].transform(raw)
        made[name] = gold.TABLES[name](clean)
        assert made[name].count() == 0
        reports = {**silver.raw_reports(name, raw), **silver.silver_reports(name, clean)}
        for report in {**reports, **gold.gold_reports(name, made[name], clean)}.values():
            report.collect()
    store = labels.label_gold(labels.label_silver(labels.label_bronze(raw)))
    assert store.count() == 0
    for mode in (training.EXACT, training.AS_OF):
        assert training.training_table(store, made, mode).count() == 0


def test_a_run_reads_the_loan_csv_once(spark, loan_csv, tmp_path):
    loan_csv(loan_line("A_1", "2023-07-01", 6, overdue="100.0"))
    root = str(tmp_path / "mart")
    tables.ingest(spark, str(tmp_path), f"{root}/bronze", {"lms_loan_daily.csv": "loan_daily"})
    (tmp_path / "lms_loan_daily.csv").unlink()
    config = {"run_label": True, "label_store": {"snapshot_dates": ["2023-07-01"]}}
    pipeline.run(spark, str(tmp_path), root, config)
    assert labels.read_label_store(spark, root).count() == 1
    stored = rows(pipeline.read_reports(spark, root).select("report", "column", "metric", "value"))
    assert stored == [("labels", "2023-07-01|30dpd_6mob", "defaults", 1.0), ("labels", "2023-07-01|30dpd_6mob", "loans", 1.0)]



@pytest.mark.parametrize("mode", [training.EXACT, training.AS_OF])
def test_training_plan_sorts_no_structs_into_groups(spark, mode):
    """No aggregate over wide rows: those cannot be hashed, so each task would sort all of them twice."""
    made = {}
    for name, (_, columns) in RAW_TABLES.items():
        raw = spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
        made[name] = gold.TABLES[name](silver.TABLES[name].transform(raw))
    store = labels.label_gold(labels.label_silver(labels.label_bronze(raw)))
    table = training.training_table(store, made, mode)
    assert "SortAggregate" not in table._jdf.queryExecution().toString()


def test_exact_join_of_bucketed_tables_shuffles_labels_only(spark, tmp_path):
    months = [D(2023, m, 1) for m in range(1, 5)]
    attrs = spark.createDataFrame([(f"C{i}", i, m) for i in range(40) for m in months], "Customer_ID string, Age int, snapshot_date date")
    loans = spark.createDataFrame(
        [(f"L{i}", f"C{i % 40}", i * 1.0, months[i % 4]) for i in range(80)], "loan_id string, Customer_ID string, ratio double, snapshot_date date"
    )
    store = label_rows(spark, [(f"L{i}", f"C{i % 40}", 1, "d", months[i % 4]) for i in range(80)])
    plain = {"attributes": attrs, "loan_daily": loans}
    keys = {n: [*training.TABLE_KEYS[n], fv.SNAPSHOT] for n in plain}
    for n, table in plain.items():
        tables.overwrite_bucketed(table, str(tmp_path / n), keys[n], 8)
    bucketed = {n: tables.read_bucketed(spark, str(tmp_path / n), keys[n], 8) for n in plain}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = training.training_table(store, bucketed)
        plan = table._jdf.queryExecution().executedPlan().toString().splitlines()
        assert rows(table) == rows(training.training_table(store, plain))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in plan]
    scans = [i for i, line in enumerate(plan) if "FileScan parquet" in line and "Bucketed: true" in line]
    assert len(scans) == 2
    for i in scans:
        above, at = [], depth[i]
        for k in range(i - 1, -1, -1):
            if depth[k] < at:
                above, at = [*above, plan[k]], depth[k]
        joined = next(k for k, line in enumerate(above) if "SortMergeJoin" in line)
        assert not any("Exchange" in line for line in above[:joined]), above[:joined]


def test_bucketed_tables_are_found_again(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["k", "snapshot_date"]
    for v in (1, 2):
        tables.overwrite_bucketed(spark.createDataFrame([("a", D(2023, 1, 1), v)], "k string, snapshot_date date, v int"), path, keys, 3)
        assert rows(tables.read_bucketed(spark, path, keys, 3)) == [("a", D(2023, 1, 1), v)]
    spark.sql(f"DROP TABLE {tables.bucketed_name(path)}")
    assert rows(tables.read_bucketed(spark, path, keys, 3)) == rows(spark.read.parquet(path)) == [("a", D(2023, 1, 1), 2)]


def test_a_run_with_buckets(spark, loan_csv, tmp_path):
    loan_csv(loan_line("A_1", "2023-07-01", 6, overdue="100.0"), loan_line("B_1", "2023-08-01", 6))
    files, found = {"lms_loan_daily.csv": "loan_daily"}, []
    for name, more in (("plain", {}), ("dealt", {"buckets": 8})):
        root = str(tmp_path / name)
        tables.ingest(spark, str(tmp_path), f"{root}/bronze", files)
        stages = dict.fromkeys(("run_silver", "run_gold", "run_label", "run_join"), True)
        months = {"snapshot_dates": ["2023-07-01", "2023-08-01"]}
        pipeline.run(spark, str(tmp_path), root, {**stages, **more, "datasets": {"loan_daily": True}, "label_store": months})
        found.append(rows(tables.read_parquet(spark, f"{root}/gold/final_training_table")))
    assert len(found[0]) == 2 and found[0] == found[1]


def test_as_of_dates_come_before_columns(spark):
    """What is sorted to find the latest date is keys and dates; no feature goes through a window or into a struct."""
    wanted = spark.createDataFrame([("C", D(2023, 5, 1), 2), ("C", D(2023, 1, 1), 1), (None, D(2023, 5, 1), 1)], "k string, _feature_date date, _n long")
    tables = {
        "a": spark.createDataFrame([("C", D(2023, 2, 1), 5.0), ("C", D(2023, 5, 1), 6.0), ("C", D(2023, 5, 1), 7.0)], "k string, snapshot_date date, wide double"),
        "b": spark.createDataFrame([("C", D(2023, 6, 1), 5.0), (None, D(2023, 1, 1), 1.0)], "k string, snapshot_date date, wide double"),
    }
    found = training._latest_dates(wanted, tables, ["k"])
    assert rows(found.select("k", "_feature_date", "_n", "_a_date", "_b_date")) == sorted(
        [
            ("C", D(2023, 5, 1), 2, D(2023, 5, 1), None),
            ("C", D(2023, 1, 1), 1, None, None),
            (None, D(2023, 5, 1), 1, None, D(2023, 1, 1)),
        ],
        key=repr,
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "wide" not in "".join(line for line in plan.splitlines() if "Window" in line or "Union" in line or "Project" in line)
    made = {}
    for name, (_, columns) in RAW_TABLES.items():
        raw = spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
        made[name] = gold.TABLES[name](silver.TABLES[name].transform(raw))
    store = labels.label_gold(labels.label_silver(labels.label_bronze(raw)))
    plan = training.training_table(store, made, training.AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert "struct(" not in "".join(line for line in plan.splitlines() if "Join" not in line and "fe_1" in line)


def test_building_gold_financials_runs_nothing(spark):
    raw = financial_table(spark, [fin_row("A", "2023-01-01")])
    spark.sparkContext.setJobGroup("building", "no job may start in here")
    table = gold.financials(silver.financials(raw))
    started = list(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert started == [] and table.count() == 1
