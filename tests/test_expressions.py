import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import casting, cleaning, features, repayment

D = dt.date


def test_int_cast_cuts_fractions(either_ansi, column):
    values = ["12", "12.7", " 12 ", "12_", "1e3", "", "-5", "99999999999", None, " +3. "]
    assert column(values, casting.to_int("v")) == [12, 12, 12, None, None, None, -5, None, None, 3]


def test_strict_int_needs_the_whole_format(either_ansi, column):
    values = ["12", "12.7", " 12 ", "12_", "-7", None]
    assert column(values, casting.to_strict_int("v")) == [12, None, None, None, -7, None]


def test_double_drops_one_suffix(either_ansi, column):
    got = column(["1.5_", "__10000__", "1e3", "NaN", "_", "", None, "-2", "3__"], casting.to_double("v", True))
    assert got[:3] == [1.5, None, 1000.0] and math.isnan(got[3]) and got[4:] == [None, None, None, -2.0, None]


def test_double_keeps_suffix_unless_asked(either_ansi, column):
    assert column(["1.5_", "1.5"], casting.to_double("v")) == [None, 1.5]


def test_date_cast(either_ansi, column):
    values = ["2023-01-01", "2023-1-1", "2023", "2023-02-30", "01/02/2023", None]
    first = D(2023, 1, 1)
    assert column(values, casting.to_date("v")) == [first, first, first, None, None, None]


def test_key_trim_takes_spaces_only(column):
    assert column([" A ", "\tA", None], cleaning.trimmed(F.col("v"))) == ["A", "\tA", None]


@pytest.mark.parametrize(
    "clean, values, expected",
    [
        (
            cleaning.occupation,
            ["_______", " ", "", "Media_Manager", None],
            ["unknown", "unknown", "unknown", "media manager", None],
        ),
        (
            cleaning.payment_behaviour,
            ["!@9#%8", "Low_spent", "_", "", None],
            ["unknown", "low spent", " ", "unknown", "unknown"],
        ),
        (
            cleaning.credit_mix,
            ["_", " ", "", "Good", " _", None],
            ["unknown", "unknown", "unknown", "good", " _", None],
        ),
        (cleaning.loan_type, [None, "", "_", "Auto Loan"], ["Not Specified"] * 3 + ["Auto Loan"]),
        (
            cleaning.min_payment,
            ["NM", None, "", "_", "Yes", "nm"],
            ["Not Measured", "Unknown", "Unknown", "Unknown", "Yes", "nm"],
        ),
        (
            cleaning.credit_history_months,
            ["22 Years and 9 Months", "1 Year and 1 Month", "5 Years", "7Months", "NA", "_", "", None, "3 years"]
            + ["999999999 Years", "9" * 30 + " Years"],
            [273, 13, 60, 7, 0, None, None, None, 0] + [None, None],
        ),
    ],
)
def test_text_cleaning(either_ansi, column, clean, values, expected):
    assert column(values, clean(F.col("v"))) == expected


def test_age_range(column):
    ages = [17, 18, 90, 91, None]
    assert column(ages, features.null_outside(F.col("v"), 18, 90), "int") == [None, 18, 90, None, None]
    assert column(ages, features.flag(features.outside(F.col("v"), 18, 90)), "int") == [1, 0, 0, 1, 0]


def test_cap_has_no_lower_bound(column):
    assert column([-100, 20, 21, None], features.cap(F.col("v"), 20), "int") == [-100, 20, 20, None]


def test_ratios_are_guarded(either_ansi, spark):
    pairs = [(1, 2), (1, 0), (1, -1), (None, 2), (1, None)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, n int, d int").orderBy("i")
    guarded = features.guarded_ratio(F.col("n"), F.col("d"))
    zero = features.ratio_or_zero(F.col("n"), F.col("d"))
    rows = df.select(guarded, zero).collect()
    assert [r[0] for r in rows] == [0.5, None, None, None, None]
    assert [r[1] for r in rows] == [0.5, 0.0, 0.0, None, 0.0]


def test_log_of_nothing_is_null(either_ansi, column):
    assert column([0.0, -1.0, -3.0, None], features.log_plus_one(F.col("v")), "double") == [0.0, None, None, None]


def test_missed_instalments_use_float32(either_ansi, spark):
    df = spark.sql("SELECT CAST(0.3 AS FLOAT) AS o, CAST(0.1 AS FLOAT) AS d")
    assert df.select(repayment.installments_missed(F.col("o"), F.col("d"))).first()[0] == 4


def test_days_past_due(either_ansi, spark):
    snapshot = D(2023, 3, 31)
    rows = [(0, snapshot, 10.0, 10.0), (1, snapshot, 0.0, 10.0), (2, snapshot, 10.0, 0.0)]
    df = spark.createDataFrame(rows, "i int, s date, o double, d double").orderBy("i")
    missed = F.coalesce(repayment.installments_missed(F.col("o"), F.col("d")), F.lit(0))
    first = repayment.first_missed_date(F.col("s"), missed)
    days = repayment.days_past_due(F.col("s"), first, F.col("o"))
    got = df.select(missed, first, days, repayment.default_label(days, 30)).collect()
    assert [tuple(r) for r in got] == [(1, D(2023, 2, 28), 31, 1), (0, None, 0, 0), (0, None, None, 0)]


def test_absurd_arrears_do_not_fail(either_ansi, spark):
    df = spark.sql("SELECT DATE'2023-01-01' AS s, 1e6D AS o, 0.01D AS d")
    missed = repayment.installments_missed(F.col("o"), F.col("d"))
    days = repayment.days_past_due(F.col("s"), repayment.first_missed_date(F.col("s"), missed), F.col("o"))
    assert df.select(days > 30).first()[0]


def test_larger_arrears_never_label_lower(either_ansi):
    """The bound on missed instalments is applied to the share itself, so no overflow turns bad loans into good ones."""
    cases = [(1e6, 0.01), (1e6, 0.0001), (1e30, 1e-30), (repayment.MOST_MONTHS * 1.0, 1.0), (3.0, 1.0), (1.0, 100.0)]
    df = either_ansi.createDataFrame(cases, "overdue double, due double")
    missed = repayment.installments_missed(F.col("overdue"), F.col("due"))
    snapshot = F.lit("2023-06-01").cast("date")
    days = repayment.days_past_due(snapshot, repayment.first_missed_date(snapshot, F.col("missed")), F.col("overdue"))
    rows = df.withColumn("missed", missed).select("missed", repayment.default_label(days, 30).alias("label")).collect()
    most = repayment.MOST_MONTHS
    assert [tuple(r) for r in rows] == [(most, 1), (most, 1), (most, 1), (most, 1), (3, 1), (1, 1)]
    odd = either_ansi.createDataFrame([(float("nan"), 1.0), (1.0, 0.0), (-1e30, 1.0)], "overdue double, due double")
    assert [r[0] for r in odd.select(missed).collect()] == [0, None, -most]


def test_ints_without_leading_digits(either_ansi, column):
    values = [".5", "-.5", ".", "+.", "12.7", " 3. ", "1.2.3", "x.5", "..", "9999999999.5"]
    assert column(values, casting.to_int("v")) == [0, 0, 0, 0, 12, 3, None, None, None, None]


def test_casts_are_left_out_only_where_they_fail(either_ansi, column):
    """The texts on which no cast is tried are those that the cast makes null."""
    values = ["7", "+7", " 7", "7 ", "\t7\n", "\x017", "\x7f7", "\x7f7\x7f", "\u00e97", "n/a", "a", "1a", "_", "1_", "_1", "7_\n", "", " "]
    values += ["NaN", " nan ", "Infinity", "-inf", "1d", "2f", "0x1p3", "1e5", ".5", "5.", "1_000.5", "__1__", "-", ":", "~", None]
    whole = [v if v is None or "." not in v else "" for v in values]
    assert column(whole, casting.to_int("v")) == column(whole, F.expr("try_cast(v AS INT)"))
    same = [str(x) for x in column(values, F.expr("try_cast(v AS DOUBLE)"))]
    assert [str(x) for x in column(values, casting.to_double("v"))] == same
    plain = [str(x) for x in column(values, F.expr("try_cast(regexp_replace(v, '_$', '') AS DOUBLE)"))]
    assert [str(x) for x in column(values, casting.to_double("v", drop_suffix=True))] == plain
    assert column(values, F.expr(casting.without_suffix("v"))) == column(values, F.expr("regexp_replace(v, '_$', '')"))


def test_a_text_that_is_no_number_costs_no_failed_cast(spark):
    """A cast is behind a test of the text, in every branch that gives one."""
    df = spark.createDataFrame([("1",)], "v string")
    for made in (casting.to_int("v"), casting.to_double("v"), casting.to_double("v", True), casting.to_float("v")):
        plan = df.select(made)._jdf.queryExecution().analyzed().toString()
        assert "Contains" in plan or "contains(" in plan.lower(), plan
        assert "coalesce(" not in plan, plan
