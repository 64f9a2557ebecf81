"""Calendar months: sequences of them and gaps between snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv


def month_starts(start: Column, end: Column) -> Column:
    """Array of the month starts from the month of ``start`` up to ``end``; empty when there is none."""
    first = F.trunc(start, "month")
    return F.when(first <= end, F.sequence(first, end, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>")
    )


def months_between(df: DataFrame, start: str, end: str) -> DataFrame:
    """A row per month start between two bounds that are columns of ``df``."""
    return df.select(F.explode(month_starts(F.col(start), F.col(end))).alias(fv.SNAPSHOT))


def month_span(column: str = fv.SNAPSHOT) -> dict[str, Column]:
    """Aggregates of a date column: its first and last date, and the set of month starts among them.

    The set holds at most twelve dates a calendar year however long the table.
    """
    date = F.col(column)
    present = F.collect_set(F.when(date == F.trunc(date, "month"), date))
    return {"low": F.min(date), "high": F.max(date), "present": present}


def gaps(span: DataFrame) -> DataFrame:
    """(missing_month) of rows with ``low``, ``high`` and ``present``."""
    from_next = F.add_months(F.trunc("low", "month"), 1)
    low = F.when(F.col("low") == F.trunc("low", "month"), F.col("low")).otherwise(from_next)
    return span.select(F.explode(F.array_except(month_starts(low, F.col("high")), "present")).alias("missing_month"))


def missing_months(df: DataFrame, column: str = fv.SNAPSHOT) -> DataFrame:
    """Month starts between the first and the last date that are not there, by one aggregation."""
    return gaps(df.agg(*[value.alias(name) for name, value in month_span(column).items()]))
