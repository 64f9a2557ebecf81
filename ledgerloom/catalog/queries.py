"""The registered queries: one per operator or job, over whole tables.

Statistics and logarithms are rounded to six places, as their last digits depend on the order of summation and on the
maths library. Rounding is part of the query only, never of the operators.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.catalog.adapters import RAW_TABLES, raw_table
from ledgerloom.functions import repayment
from ledgerloom.functions.casting import cast_to
from ledgerloom.operators import quality, state
from ledgerloom.operators.categories import category_counts, group_rare
from ledgerloom.operators.dedup import first_per_key
from ledgerloom.operators.months import missing_months, months_between
from ledgerloom.operators.statistics import impute_mean, moments
from ledgerloom.plans import gold, labels, pipeline, silver, training
from ledgerloom.session import tune
from ledgerloom.sources import evolution, folders, tables
from ledgerloom.sources.scratch import scratch_folder, stored
from ledgerloom.sources.store import SnapshotStore

Query = Callable[[SparkSession, str], DataFrame]

SHORT = {"click": "clickstream", "attr": "attributes", "fin": "financials", "loan": "loan_daily"}
ATTRIBUTE_FLAGS = ("age_outlier_flag", "age_missing_flag", "unknown_occupation_flag")
PLACES = 6
# A compressed file is read by one task
RECORDS_PER_FILE = 500_000
# Gold tables that read silver twice, for statistics of all rows and for the rows
TWICE_READ = ("clickstream", "financials")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, PLACES) for c in columns})


def silver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return silver.TABLES[name].transform(raw_table(spark, sf_dir, name))


def gold_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Silver that is read twice is stored, as casts of text cost more than reading their results."""
    silver = silver_table(spark, sf_dir, name)
    return gold.TABLES[name](stored(silver, "silver") if name in TWICE_READ else silver)


def financials_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_table(spark, sf_dir, "financials")


def loan_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_table(spark, sf_dir, "loan_daily")


# Labels


def snapshot_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loans of the latest snapshot."""
    dated = labels.label_bronze(raw_table(spark, sf_dir, "loan_daily"))
    return dated.filter(F.col(fv.SNAPSHOT) == dated.agg(F.max(fv.SNAPSHOT)).scalar())


def label_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_silver(labels.label_bronze(raw_table(spark, sf_dir, "loan_daily")))


def label_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_gold(label_silver(spark, sf_dir))


def label_store_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another definition: 60 days past due at month 4."""
    return labels.label_gold(label_silver(spark, sf_dir), dpd=60, mob=4)


def label_rate_by_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.label_report(label_store(spark, sf_dir))


def month_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months that the loans span."""
    span = loan_silver(spark, sf_dir).agg(
        F.min("loan_start_date").alias("start"), F.max("loan_start_date").alias("end")
    )
    return months_between(span, "start", "end")


# Financial feature parts


def fin_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    capped = gold.financial_features(financials_silver(spark, sf_dir))
    flags = [f"{c.lower()}_outlier_flag" for c in fv.FINANCIAL_CAPS]
    return capped.select(*fv.CUSTOMER_KEY, *fv.FINANCIAL_CAPS, *flags)


def fin_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = gold.financial_features(financials_silver(spark, sf_dir))
    missing = [f"{c.lower()}_missing_flag" for c in fv.IMPUTED_COLUMNS]
    return features.select(*fv.CUSTOMER_KEY, *missing, *fv.UNKNOWN_FLAGS)


def fin_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = gold.financial_features(financials_silver(spark, sf_dir))
    return features.select(*fv.CUSTOMER_KEY, *fv.FINANCIAL_RATIOS)


def fin_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"log_{c}" for c in fv.LOGGED_COLUMNS]
    features = gold.financial_features(financials_silver(spark, sf_dir))
    return rounded(features.select(*fv.CUSTOMER_KEY, *names), *names)


def fin_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_counts(financials_silver(spark, sf_dir), fv.GROUPED_COLUMN)


def fin_rare_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = financials_silver(spark, sf_dir).select(*fv.CUSTOMER_KEY, fv.GROUPED_COLUMN)
    return group_rare(kept, fv.GROUPED_COLUMN)


def fin_imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = gold.financial_features(financials_silver(spark, sf_dir))
    kept = features.select(*fv.CUSTOMER_KEY, *fv.IMPUTED_COLUMNS)
    return rounded(impute_mean(kept, fv.IMPUTED_COLUMNS), *fv.IMPUTED_COLUMNS)


def fin_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(financials_silver(spark, sf_dir), fv.CUSTOMER_KEY)


def fin_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold.financial_rates(financials_silver(spark, sf_dir)), "rate")


def fin_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_bearing(gold.financial_features(financials_silver(spark, sf_dir)))


# Gold tables


def gold_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold_table(spark, sf_dir, "clickstream"), *fv.CLICK_FEATURES)


def _grown_state(spark: SparkSession, silver: DataFrame, state_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stored state of a table that came in two parts: rows up to a date and without one, then the later ones."""
    path = scratch_folder(spark, "state")
    last = silver.agg(F.max(fv.SNAPSHOT)).first()[0]
    later = F.coalesce(F.col(fv.SNAPSHOT) == F.lit(last), F.lit(False))
    for part in (silver.filter(~later), silver.filter(later)):
        state.write_state(state_of(part), path)
    return state.read_state(spark, path, state_of(silver))


def gold_click_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold from the merged states of snapshots: the last one was added to those before it."""
    silver = silver_table(spark, sf_dir, "clickstream")
    moments_of = state.merged_moments(_grown_state(spark, silver, gold.click_state), fv.CLICK_FEATURES)
    return rounded(gold.clickstream(silver, moments=moments_of), *fv.CLICK_FEATURES)


def gold_fin_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = financials_silver(spark, sf_dir)
    counts = state.merged_categories(_grown_state(spark, silver, gold.financial_state), fv.GROUPED_COLUMN)
    names = [*fv.IMPUTED_COLUMNS, *[f"log_{c}" for c in fv.LOGGED_COLUMNS]]
    return rounded(gold.financials(silver, counts=counts), *names)


def gold_attr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_table(spark, sf_dir, "attributes")


def gold_fin(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [*fv.IMPUTED_COLUMNS, *[f"log_{c}" for c in fv.LOGGED_COLUMNS]]
    return rounded(gold_table(spark, sf_dir, "financials"), *names)


def gold_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_table(spark, sf_dir, "loan_daily")


def loan_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.loan_features(loan_silver(spark, sf_dir))


def loan_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(loan_silver(spark, sf_dir), fv.LOAN_KEY)


# Gold reports


def click_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = moments(silver_table(spark, sf_dir, "clickstream"), fv.CLICK_FEATURES)
    return rounded(stats, *stats.columns)


def click_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.table_shape(gold_table(spark, sf_dir, "clickstream"))


def flag_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.flag_totals(gold_attr(spark, sf_dir), ATTRIBUTE_FLAGS)


def loan_flag_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.value_distribution(gold_loan(spark, sf_dir), fv.LOAN_FLAGS), "pct")


MOMENTS = ("mean", "stddev", "min", "max")


def _exact_part(summary: DataFrame) -> DataFrame:
    """A summary but for its quartiles, which are estimates."""
    return rounded(summary.drop(*quality.QUARTILES), *MOMENTS)


def feature_summary_fin(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = gold_table(spark, sf_dir, "financials")
    return _exact_part(quality.feature_summary(table, fv.FINANCIAL_SUMMARY_COLUMNS))


def feature_summary_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact_part(quality.feature_summary(gold_loan(spark, sf_dir), fv.LOAN_SUMMARY_COLUMNS))


def feature_quartiles_fin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the sketched quartiles have the ranks they should have."""
    return quality.quartile_ranks(gold_table(spark, sf_dir, "financials"), fv.FINANCIAL_SUMMARY_COLUMNS)


def feature_quartiles_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quartile_ranks(gold_loan(spark, sf_dir), fv.LOAN_SUMMARY_COLUMNS)


# Training table


def _side_by_side(work: Callable, items) -> list:
    """The results of jobs that do not depend on each other, so that one's last tasks leave no cores idle."""
    with ThreadPoolExecutor(max_workers=len(RAW_TABLES)) as pool:
        return list(pool.map(work, items))


def training_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The labels, which are read twice and so stored, and the gold tables by name."""

    def part(name: str) -> DataFrame:
        return gold_table(spark, sf_dir, name) if name in RAW_TABLES else stored(label_store(spark, sf_dir), name)

    labelled, *found = _side_by_side(part, ["labels", *RAW_TABLES])
    return labelled, dict(zip(RAW_TABLES, found, strict=True))


def _rounded_training(table: DataFrame) -> DataFrame:
    logs = [f"log_{c}" for c in fv.LOGGED_COLUMNS]
    return rounded(table, *fv.CLICK_FEATURES, *fv.IMPUTED_COLUMNS, *logs)


def training_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_training(training.training_table(*training_parts(spark, sf_dir), training.EXACT))


def training_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_training(training.training_table(*training_parts(spark, sf_dir), training.AS_OF))


# Sources, sinks and jobs: these store tables in a new folder and read them back


def _write_csv(df: DataFrame, path: str) -> None:
    """Compressed, as text takes several times the space of the tables it is made of; in files that tasks can read side by side."""
    keep_spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(header=True, compression="gzip", maxRecordsPerFile=RECORDS_PER_FILE, **keep_spaces).csv(path)


def _raw_folder(spark: SparkSession, sf_dir: str, *names: str) -> str:
    folder = scratch_folder(spark, "raw")
    files = [(file, name) for file, name in fv.RAW_FILES.items() if name in names]
    _side_by_side(lambda f: _write_csv(raw_table(spark, sf_dir, f[1]), f"{folder}/{f[0]}"), files)
    return folder


def _untidy_csv(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A folder with the table's CSV, in which some lines have a field more or less than the header."""
    raw, folder = raw_table(spark, sf_dir, name), scratch_folder(spark, "untidy")
    file = next(f for f, t in fv.RAW_FILES.items() if t == name)
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    line = F.to_csv(F.struct(*raw.columns), kept)
    digit = F.expr(f"CAST(regexp_extract({fv.CUSTOMER}, '([0-9]+)', 1) AS BIGINT) % 10")
    longer, shorter = F.concat(line, F.lit(",surplus")), F.regexp_replace(line, ",[^,]*$", "")
    lines = raw.select(F.when(digit == 3, longer).when(digit == 7, shorter).otherwise(line).alias(",".join(raw.columns)))
    # a single column that is neither split nor quoted
    lines.write.options(header=True, sep="\u0001", quote="", **kept).csv(f"{folder}/{file}")
    return folder


def _checked_ingest(spark: SparkSession, sf_dir: str, *names: str) -> str:
    target = scratch_folder(spark, "bronze")

    def ingest(name: str) -> None:
        files = {f: t for f, t in fv.RAW_FILES.items() if t == name}
        tables.ingest(spark, _untidy_csv(spark, sf_dir, name), target, files)

    _side_by_side(ingest, names)
    return target


def _csv_rejects(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rejects = tables.read_rejects(spark, _checked_ingest(spark, sf_dir, name), name)
    return rejects.select("first_field", "fields", "expected", "reason")


def csv_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every table its lines, the rows in bronze and the rejects: no line gets lost."""
    target = _checked_ingest(spark, sf_dir, *RAW_TABLES)
    parts = []
    for name in RAW_TABLES:
        bronze = tables.read_parquet(spark, f"{target}/{name}").select(F.lit("bronze").alias("where"))
        rejects = tables.read_rejects(spark, target, name).select(F.lit("rejects").alias("where"))
        raw = raw_table(spark, sf_dir, name).select(F.lit("lines").alias("where"))
        counted = raw.unionAll(bronze).unionAll(rejects).groupBy("where").agg(F.count(F.lit(1)).alias("rows"))
        parts.append(counted.select(F.lit(name).alias("table"), "where", "rows"))
    return reduce(DataFrame.unionAll, parts)


def _bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, target = _raw_folder(spark, sf_dir, name), scratch_folder(spark, "bronze")
    tables.ingest(spark, source, target, {f: t for f, t in fv.RAW_FILES.items() if t == name})
    return tables.read_parquet(spark, f"{target}/{name}")


def _loan_months(spark: SparkSession, sf_dir: str) -> list[str]:
    """The loans' snapshot dates: a value a month."""
    dates = loan_silver(spark, sf_dir).select(fv.SNAPSHOT).dropna().distinct().collect()
    return sorted(str(r[0]) for r in dates)


def label_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label store by way of its bronze, silver and gold snapshot folders, the gold one written twice."""
    root, dates = scratch_folder(spark, "labels"), _loan_months(spark, sf_dir)
    source = f"{_raw_folder(spark, sf_dir, 'loan_daily')}/{pipeline.LOAN_FILE}"
    labels.build_label_store(spark, source, root, dates)
    return labels.build_label_store(spark, source, root, dates[: len(dates) // 2])


def _evolved_store(spark: SparkSession, sf_dir: str) -> SnapshotStore:
    """Loan snapshots of four shapes, by month: without a column, with one more, with typed columns, as they are."""
    loans = labels.label_bronze(raw_table(spark, sf_dir, "loan_daily"))
    store = SnapshotStore(spark, scratch_folder(spark, "evolved"))
    days = _loan_months(spark, sf_dir)
    shapes: dict[int, Callable[[DataFrame], DataFrame]] = {
        0: lambda df: df.drop("balance"),
        1: lambda df: df.withColumn("channel", F.concat(F.lit("c"), F.length(fv.LOAN).cast("string"))),
        2: lambda df: df.withColumns(
            {"installment_num": cast_to("installment_num", "int"), "overdue_amt": cast_to("overdue_amt", "double")}
        ),
        3: lambda df: df,
    }
    for k, shape in shapes.items():
        some = [d for d in days if int(d[5:7]) % len(shapes) == k]
        store.write(shape(tables.at_snapshot(loans, *some)), some, gather=True)
    return store


def label_snapshots_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of snapshots whose columns differ, with a column that some lack and one that only some have."""
    loans = labels.label_silver(evolution.read_merged(_evolved_store(spark, sf_dir)))
    own = loans.select(fv.LOAN, fv.CUSTOMER, fv.SNAPSHOT, "mob", "dpd", "balance", "channel")
    named = own.filter(F.col("mob") == fv.MOB).withColumns(
        {"label": repayment.default_label(F.col("dpd"), fv.DPD), "label_def": F.lit(repayment.label_name(fv.DPD, fv.MOB))}
    )
    return named.select(*fv.LABEL_COLUMNS, "balance", "channel")


def schema_report_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evolution.schema_report(_evolved_store(spark, sf_dir), fv.LABEL_TYPES)


def prune_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label folders, two of them empty, after the removal of the empty ones."""
    root, store = scratch_folder(spark, "labels"), label_store(spark, sf_dir)
    tables.overwrite_snapshots(store, root, gather=True)
    for day in ("1900-01-01", "1900-02-01"):
        tables.overwrite_parquet(store.filter(F.lit(False)).drop(fv.SNAPSHOT), f"{root}/{fv.SNAPSHOT}={day}")
    return folders.prune_empty_folders(spark, root)


def _run(spark: SparkSession, sf_dir: str, mode: str) -> tuple[str, dict[str, DataFrame]]:
    """All stages from CSV files on; the folder they are in and the reports."""
    source, root = _raw_folder(spark, sf_dir, *RAW_TABLES), scratch_folder(spark, "run")
    stages = ("run_bronze", "run_silver", "run_gold", "run_label", "run_label_cleanup", "run_join")
    config = {
        **dict.fromkeys(stages, True),
        "datasets": dict.fromkeys(RAW_TABLES, True),
        "label_store": {"dpd": fv.DPD, "mob": fv.MOB, "snapshot_dates": _loan_months(spark, sf_dir)},
    }
    reports = pipeline.run(spark, source, root, config, mode)
    folders.delete(spark, source)  # bronze has been made of it, and nothing else reads it
    return root, reports


def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored training table of a whole run."""
    root, _ = _run(spark, sf_dir, training.EXACT)
    return _rounded_training(tables.read_parquet(spark, f"{root}/gold/final_training_table"))


def full_run_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _run(spark, sf_dir, training.AS_OF)
    return _rounded_training(tables.read_parquet(spark, f"{root}/gold/final_training_table"))


def run_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored reports of a whole run, without the estimated quartiles."""
    root, _ = _run(spark, sf_dir, training.EXACT)
    return rounded(pipeline.read_reports(spark, root).filter(~F.col("metric").isin(*quality.QUARTILES)), "value")


def _per_table() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for short, name in SHORT.items():
        rules, keys, ranges = silver.TABLES[name].rules, silver.TABLES[name].keys, silver.TABLES[name].ranges

        def of_silver(operator, name=name) -> Query:
            return lambda spark, sf_dir: operator(silver_table(spark, sf_dir, name))

        def of_raw(operator, name=name) -> Query:
            return lambda spark, sf_dir: operator(raw_table(spark, sf_dir, name))

        found[f"invalid_{short}"] = of_raw(lambda df, rules=rules: quality.invalid_counts(df, rules))
        found[f"invalid_summary_{short}"] = of_raw(lambda df, rules=rules: quality.invalid_summary(df, rules))
        found[f"invalid_samples_{short}"] = of_raw(lambda df, rules=rules: quality.invalid_samples(df, rules))
        found[f"silver_{short}"] = of_silver(lambda df: df)
        found[f"null_profile_{short}"] = of_silver(quality.null_profile)
        found[f"dup_keys_{short}"] = of_silver(lambda df, keys=keys: quality.duplicate_keys(df, keys))
        found[f"missing_months_{short}"] = of_silver(missing_months)
        found[f"range_profile_{short}"] = of_silver(
            lambda df, ranges=ranges: rounded(quality.range_profile(df, ranges(df)), "min", "max", "mean")
        )
        found[f"csv_rejects_{short}"] = lambda spark, sf_dir, name=name: _csv_rejects(spark, sf_dir, name)
        found[f"csv_bronze_{short}"] = lambda spark, sf_dir, name=name: _bronze(spark, sf_dir, name)
    return found


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


def all_queries() -> dict[str, Query]:
    single = [
        snapshot_slice,
        label_silver,
        label_store,
        label_store_strict,
        label_rate_by_snapshot,
        month_sequence,
        fin_caps,
        fin_flags,
        fin_ratios,
        fin_logs,
        fin_category_counts,
        fin_rare_groups,
        fin_imputed,
        fin_dedup,
        fin_rates,
        fin_null_columns,
        gold_click,
        gold_click_from_state,
        gold_fin_from_state,
        gold_attr,
        gold_fin,
        gold_loan,
        loan_features,
        loan_dedup,
        click_moments,
        click_shape,
        flag_totals,
        loan_flag_distribution,
        feature_summary_fin,
        feature_summary_loan,
        feature_quartiles_fin,
        feature_quartiles_loan,
        training_exact,
        training_as_of,
        csv_accounts,
        label_snapshots,
        label_snapshots_evolved,
        schema_report_loan,
        prune_empty,
        full_run,
        full_run_as_of,
        run_reports,
    ]
    loan_keys: Query = lambda spark, sf_dir: quality.duplicate_keys(loan_silver(spark, sf_dir), fv.LOAN_KEY)
    found = {**_per_table(), "dup_loan_snapshots": loan_keys, **{q.__name__: q for q in single}}
    return {name: _tuned(query) for name, query in found.items()}
