"""Silver tables to model-ready feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions import features as fx
from ledgerloom.operators import quality
from ledgerloom.operators.categories import category_counts, group_rare, overall_means
from ledgerloom.operators.dedup import first_per_key
from ledgerloom.operators.state import category_state, moment_state
from ledgerloom.operators.statistics import clip_sigma, impute_mean


def clickstream(silver: DataFrame, sigmas: float = fv.SIGMAS, moments: DataFrame | None = None) -> DataFrame:
    """``moments`` are stored ones, see ``merged_moments``; by default those of ``silver``, which is then read twice."""
    return clip_sigma(silver, fv.CLICK_FEATURES, sigmas, moments)


def click_state(silver: DataFrame) -> DataFrame:
    """What ``clickstream`` needs to know of whole snapshots."""
    return moment_state(silver, fv.CLICK_FEATURES)


def attributes(silver: DataFrame, age_range: tuple[int, int] = fv.AGE_RANGE) -> DataFrame:
    """An age out of range is made null, and so counts as missing too."""
    age = F.col("Age")
    kept = fx.null_outside(age, *age_range)
    return silver.withColumns(
        {
            "Age": kept,
            "age_outlier_flag": fx.flag(fx.outside(age, *age_range)),
            "age_missing_flag": fx.missing_flag(kept),
            "unknown_occupation_flag": fx.flag(F.col("Occupation") == fv.UNKNOWN),
        }
    )


# Financials: the parts of the gold table, each a function of silver columns


def outlier_flags(caps: dict[str, float]) -> dict[str, Column]:
    return {f"{c.lower()}_outlier_flag": fx.flag(F.col(c) > top) for c, top in caps.items()}


def missing_flags(columns=fv.IMPUTED_COLUMNS) -> dict[str, Column]:
    return {f"{c.lower()}_missing_flag": fx.missing_flag(F.col(c)) for c in columns}


def unknown_flags() -> dict[str, Column]:
    return {name: fx.flag(F.col(c) == value) for name, (c, value) in fv.UNKNOWN_FLAGS.items()}


def capped(caps: dict[str, float]) -> dict[str, Column]:
    return {c: fx.cap(F.col(c), top) for c, top in caps.items()}


def ratios() -> dict[str, Column]:
    return {name: fx.guarded_ratio(F.col(n), F.col(d)) for name, (n, d) in fv.FINANCIAL_RATIOS.items()}


def logs(columns=fv.LOGGED_COLUMNS) -> dict[str, Column]:
    return {f"log_{c}": fx.log_plus_one(F.col(c)) for c in columns}


def financial_features(silver: DataFrame, caps: dict[str, float] | None = None) -> DataFrame:
    """The features that follow from one row. Ratios and logs use capped values that are not imputed yet."""
    caps = caps or fv.FINANCIAL_CAPS
    flagged = silver.withColumns({**outlier_flags(caps), **capped(caps), **missing_flags(), **unknown_flags()})
    return flagged.withColumns({**ratios(), **logs()}).drop("Credit_History_Age")


def financial_state(silver: DataFrame, caps: dict[str, float] | None = None) -> DataFrame:
    """What ``financials`` needs to know of whole snapshots."""
    return category_state(silver.withColumns(capped(caps or fv.FINANCIAL_CAPS)), fv.GROUPED_COLUMN, means=fv.IMPUTED_COLUMNS)


def financials(
    silver: DataFrame,
    caps: dict[str, float] | None = None,
    rare_below: int = fv.RARE_BELOW,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Cap, flag, relate, log, group and impute, for one row per customer and snapshot.

    Category counts and means are those of all silver rows, from one aggregate; the other features follow from one row.
    So the rows are deduplicated first, and only silver columns are shuffled for it. Building the frame runs nothing.
    ``counts`` are stored ones, see ``merged_categories``; by default those of ``silver``.
    """
    features = financial_features(first_per_key(silver, fv.CUSTOMER_KEY), caps)
    if counts is None:
        counts = category_counts(
            silver.withColumns(capped(caps or fv.FINANCIAL_CAPS)), fv.GROUPED_COLUMN, means=fv.IMPUTED_COLUMNS
        )
    grouped = group_rare(features, fv.GROUPED_COLUMN, rare_below, counts, salt_by=fv.CUSTOMER_KEY)
    return impute_mean(grouped, fv.IMPUTED_COLUMNS, overall_means(counts, fv.IMPUTED_COLUMNS))


def financial_rates(silver: DataFrame, caps: dict[str, float] | None = None) -> DataFrame:
    """(condition, hits, total, rate) of capped, missing and unknown values among all silver rows."""
    by_flag = {**outlier_flags(caps or fv.FINANCIAL_CAPS), **missing_flags(), **unknown_flags()}
    return quality.flag_rates(silver.withColumns(by_flag), list(by_flag))


def loan_features(silver: DataFrame) -> DataFrame:
    due, paid, overdue = F.col("due_amt"), F.col("paid_amt"), F.col("overdue_amt")
    balance, amount = F.col("balance"), F.col("loan_amt")
    payment = fx.ratio_or_zero(paid, due)

    def rounded(value: Column) -> Column:
        return F.round(value, fv.LOAN_DECIMALS)

    return silver.withColumns(
        {
            "payment_ratio": rounded(payment),
            "payment_ratio_clipped": rounded(fx.cap(payment, fv.PAYMENT_RATIO_CAP)),
            "underpaid_flag": fx.flag((due > 0) & (paid < due)),
            "has_overdue_flag": fx.flag(overdue > 0),
            "large_balance_flag": fx.flag(balance > fv.LARGE_BALANCE_ABOVE),
            "constant_tenure_flag": fx.flag(F.col("tenure") == fv.CONSTANT_TENURE),
            "percent_paid": rounded(fx.ratio_or_zero(paid, amount)),
            "log_overdue_amt": rounded(fx.log_plus_one(overdue)),
            "balance_to_loan_ratio": rounded(fx.ratio_or_zero(balance, amount)),
        }
    )


def loan_daily(silver: DataFrame) -> DataFrame:
    """Repayment features, one row per loan and snapshot. The narrower silver rows are what is shuffled."""
    return loan_features(first_per_key(silver, fv.LOAN_KEY))


TABLES = {
    "clickstream": clickstream,
    "attributes": attributes,
    "financials": financials,
    "loan_daily": loan_daily,
}


def gold_reports(name: str, gold: DataFrame, silver: DataFrame) -> dict[str, DataFrame]:
    if name == "clickstream":
        return {"shape": quality.table_shape(gold)}
    if name == "attributes":
        flags = ("age_outlier_flag", "age_missing_flag", "unknown_occupation_flag")
        return {"flag_totals": quality.flag_totals(gold, flags)}
    if name == "financials":
        return {
            "rates": financial_rates(silver),
            "null_columns": quality.null_bearing(financial_features(silver)),
            "duplicates": quality.duplicate_keys(silver, fv.CUSTOMER_KEY),
            "summary": quality.feature_summary(gold, fv.FINANCIAL_SUMMARY_COLUMNS),
        }
    return {
        "duplicates": quality.duplicate_keys(silver, fv.LOAN_KEY),
        "summary": quality.feature_summary(gold, fv.LOAN_SUMMARY_COLUMNS),
        "flags": quality.value_distribution(gold, fv.LOAN_FLAGS),
    }
