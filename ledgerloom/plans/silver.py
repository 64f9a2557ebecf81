"""Raw text tables to typed, cleaned silver tables, with the format rules and reports that go with each."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions import casting, cleaning
from ledgerloom.operators import quality
from ledgerloom.operators.months import gaps, missing_months, month_span
from ledgerloom.operators.quality import FormatRule, rules_for


def clickstream(raw: DataFrame) -> DataFrame:
    return raw.select(
        *[casting.to_int(c).alias(c) for c in fv.CLICK_FEATURES],
        cleaning.trimmed(F.col(fv.CUSTOMER)).alias(fv.CUSTOMER),
        casting.to_date(fv.SNAPSHOT).alias(fv.SNAPSHOT),
    )


def attributes(raw: DataFrame) -> DataFrame:
    return raw.select(
        cleaning.trimmed(F.col(fv.CUSTOMER)).alias(fv.CUSTOMER),
        casting.to_strict_int("Age").alias("Age"),
        cleaning.occupation(F.col("Occupation")).alias("Occupation"),
        casting.to_date(fv.SNAPSHOT).alias(fv.SNAPSHOT),
    )


def financials(raw: DataFrame) -> DataFrame:
    """Columns that are not known here pass through as they are."""
    typed = {
        fv.CUSTOMER: cleaning.trimmed(F.col(fv.CUSTOMER)),
        **{c: casting.to_double(c, drop_suffix=True) for c in fv.FINANCIAL_AMOUNTS},
        **{c: casting.to_int(c) for c in fv.FINANCIAL_COUNTS},
        "Credit_Mix": cleaning.credit_mix(F.col("Credit_Mix")),
        "Payment_Behaviour": cleaning.payment_behaviour(F.col("Payment_Behaviour")),
        "Type_of_Loan": cleaning.loan_type(F.col("Type_of_Loan")),
        "Payment_of_Min_Amount": cleaning.min_payment(F.col("Payment_of_Min_Amount")),
        fv.SNAPSHOT: casting.to_date(fv.SNAPSHOT),
        "Credit_History_Months": cleaning.credit_history_months(F.col("Credit_History_Age")),
    }
    return raw.withColumns(typed)


def loan_daily(raw: DataFrame) -> DataFrame:
    typed = {
        fv.CUSTOMER: cleaning.trimmed(F.col(fv.CUSTOMER)),
        **{c: casting.to_date(c) for c in fv.LOAN_DATES},
        **{c: casting.to_int(c) for c in fv.LOAN_COUNTS},
        **{c: casting.to_double(c) for c in fv.LOAN_AMOUNTS},
    }
    return raw.select(*[typed.get(c, F.col(c)).alias(c) for c in fv.LOAN_COLUMNS])


@dataclass(frozen=True)
class SilverTable:
    """How one raw table is cleaned, which formats it should have, and what is profiled afterwards."""

    transform: Callable[[DataFrame], DataFrame]
    rules: Sequence[FormatRule]
    ranges: Callable[[DataFrame], Sequence[str]]
    keys: Sequence[str] = fv.CUSTOMER_KEY


TABLES = {
    "clickstream": SilverTable(
        clickstream,
        rules_for(fv.CLICK_FEATURES, fv.INTEGER_PATTERN) + rules_for([fv.SNAPSHOT], fv.DATE_PATTERN),
        lambda df: fv.CLICK_FEATURES,
    ),
    "attributes": SilverTable(
        attributes,
        rules_for(["Age"], fv.INTEGER_PATTERN) + rules_for([fv.SNAPSHOT], fv.DATE_PATTERN),
        lambda df: ("Age",),
    ),
    "financials": SilverTable(
        financials,
        rules_for(fv.FINANCIAL_AMOUNTS, fv.DECIMAL_DIGITS_PATTERN, allow_suffix=True)
        + rules_for(fv.FINANCIAL_COUNTS, fv.INTEGER_DIGITS_PATTERN)
        + rules_for([fv.SNAPSHOT], fv.DATE_PATTERN),
        lambda df: quality.numeric_columns(df, but=("Credit_History_Months",)),
    ),
    "loan_daily": SilverTable(
        loan_daily,
        rules_for(fv.LOAN_DATES, fv.DATE_PATTERN)
        + rules_for(fv.LOAN_COUNTS, fv.INTEGER_PATTERN)
        + rules_for(fv.LOAN_AMOUNTS, fv.DECIMAL_PATTERN),
        lambda df: (*fv.LOAN_COUNTS, *fv.LOAN_AMOUNTS),
    ),
}


def raw_reports(name: str, raw: DataFrame) -> dict[str, DataFrame]:
    table = TABLES[name]
    return {
        "invalid": quality.invalid_summary(raw, table.rules),
        "invalid_samples": quality.invalid_samples(raw, table.rules),
    }


def silver_reports(name: str, silver: DataFrame) -> dict[str, DataFrame]:
    table = TABLES[name]
    return {
        "nulls": quality.null_profile(silver),
        "duplicates": quality.duplicate_keys(silver, table.keys),
        "missing_months": missing_months(silver),
        "ranges": quality.range_profile(silver, table.ranges(silver)),
    }


class ObservedSilver:
    """A silver table whose reports are counted while it is written, so that they need no scan of their own.

    ``clean`` gives the table to write. Afterwards ``reports`` has what ``raw_reports`` and ``silver_reports`` would have
    found, by name: counts and extremes were taken from the rows on their way. What needs rows of one key or the first
    rows in some order (duplicates, samples) is not among them.
    """

    def __init__(self, name: str) -> None:
        self.table = TABLES[name]
        self._raw, self._silver = Observation(), Observation()
        self._columns: list[str] = []
        self._ranged: list[str] = []

    def clean(self, raw: DataFrame) -> DataFrame:
        broken = {f"invalid {r.column}": F.expr(f"count_if({r.broken()})") for r in self.table.rules}
        silver = self.table.transform(_observed(raw, self._raw, broken))
        self._columns, self._ranged = silver.columns, list(self.table.ranges(silver))
        measures = {f"nulls {c}": F.count_if(F.col(casting.quoted(c)).isNull()) for c in self._columns}
        for c in self._ranged:
            value = F.col(casting.quoted(c))
            measures |= {f"min {c}": F.min(value).cast("double"), f"max {c}": F.max(value).cast("double"), f"mean {c}": F.avg(value)}
        # dates leave as text, which any driver reads alike
        span = month_span()
        months = {n: v.cast("array<string>" if n == "present" else "string") for n, v in span.items()}
        return _observed(silver, self._silver, {**measures, **months})

    def reports(self, spark: SparkSession) -> dict[str, DataFrame]:
        raw, silver = self._raw.get, self._silver.get
        invalid = [(r.column, raw[f"invalid {r.column}"]) for r in self.table.rules]
        ranges = [(c, *(silver[f"{m} {c}"] for m in ("min", "max", "mean"))) for c in self._ranged]
        span = [(silver["low"], silver["high"], list(silver["present"]))]
        dates = spark.createDataFrame(span, "low string, high string, present array<string>").selectExpr(
            "CAST(low AS DATE) AS low", "CAST(high AS DATE) AS high", "CAST(present AS ARRAY<DATE>) AS present"
        )
        return {
            "invalid": spark.createDataFrame([r for r in invalid if r[1]], "column string, invalid long"),
            "nulls": spark.createDataFrame([(c, silver[f"nulls {c}"]) for c in self._columns], "column string, nulls long"),
            "missing_months": gaps(dates),
            "ranges": spark.createDataFrame(ranges, "column string, min double, max double, mean double"),
        }


def _observed(df: DataFrame, into: Observation, measures: dict[str, Column]) -> DataFrame:
    return df.observe(into, *[value.alias(name) for name, value in measures.items()])
