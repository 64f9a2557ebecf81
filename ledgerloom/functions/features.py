"""Feature expressions shared by the gold tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def missing_flag(value: Column) -> Column:
    return value.isNull().cast("int")


def outside(value: Column, low, high) -> Column:
    """Null for a null value or bound."""
    return ~value.between(low, high)


def null_outside(value: Column, low, high) -> Column:
    return F.when(value.between(low, high), value)


def cap(value: Column, top) -> Column:
    return F.when(value > top, F.lit(top)).otherwise(value)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Null unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """0 where the denominator is null or not positive; null where only the numerator is."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def log_plus_one(value: Column) -> Column:
    return F.log(value + 1)
