"""Text clean-up: one built-in expression per kind of untidy column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv


def trimmed(key: Column) -> Column:
    """Drop spaces (and only spaces) around a key."""
    return F.trim(key)


def spaced_lower(text: Column) -> Column:
    """Lower case, with every underscore made a space."""
    return F.lower(F.translate(text, fv.PLACEHOLDER, " "))


def is_placeholder(text: Column) -> Column:
    """Null, empty, or a lone underscore. Never null itself."""
    return F.coalesce(text, F.lit("")).isin("", fv.PLACEHOLDER)


def occupation(text: Column) -> Column:
    """Blank becomes unknown; null stays null."""
    spaced = spaced_lower(text)
    return F.when(spaced.rlike(fv.BLANK_PATTERN), fv.UNKNOWN).otherwise(spaced)


def credit_mix(text: Column) -> Column:
    """A lone underscore, or nothing but spaces, becomes unknown; null stays null."""
    absent = text.eqNullSafe(fv.PLACEHOLDER) | F.trim(text).eqNullSafe("")
    return F.when(absent, fv.UNKNOWN).otherwise(F.lower(text))


def payment_behaviour(text: Column) -> Column:
    """Readable text is spaced and lowered; garbage, empty and null become unknown."""
    readable = F.coalesce(text.rlike(fv.PAYMENT_BEHAVIOUR_PATTERN), F.lit(False))
    return F.when(~readable, fv.UNKNOWN).otherwise(spaced_lower(text))


def loan_type(text: Column) -> Column:
    return F.when(is_placeholder(text), fv.NOT_SPECIFIED).otherwise(text)


def min_payment(text: Column) -> Column:
    """Spell the not-measured code out; placeholders become unknown."""
    return (
        F.when(is_placeholder(text), fv.UNKNOWN_MIN_PAYMENT)
        .when(text == fv.NOT_MEASURED_CODE, fv.NOT_MEASURED)
        .otherwise(text)
    )


def credit_history_months(text: Column) -> Column:
    """``22 Years and 9 Months`` as 273. A part that is not there counts 0; placeholders give null.

    A number too long to be counted gives null too, it does not pass for a missing one.
    """

    def part(pattern: str) -> Column:
        digits = F.regexp_extract(text, pattern, 1)
        return F.when(digits == "", F.lit(0).cast("bigint")).otherwise(digits.try_cast("bigint"))

    months = F.try_add(F.try_multiply(part(fv.YEARS_PATTERN), F.lit(12)), part(fv.MONTHS_PATTERN))
    return F.when(~is_placeholder(text), months.try_cast("int"))
