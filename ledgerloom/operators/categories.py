"""Grouping of rare category values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.casting import quoted

# Parts that a category's rows are dealt into where there are too many rare categories for Spark to broadcast them
SALTS = 64


def category_aggregates(means: Sequence[str] = ()) -> list[Column]:
    """The aggregates of ``category_counts``; those of parts of a table add up to those of the whole."""
    parts = {f"{c} {name}": f"{name}(CAST({quoted(c)} AS DOUBLE))" for c in means for name in ("sum", "count")}
    return [F.count(F.lit(1)).alias("rows"), *[F.expr(sql).alias(alias) for alias, sql in parts.items()]]


def category_counts(df: DataFrame, column: str, means: Sequence[str] = ()) -> DataFrame:
    """(column, rows) and, for each of ``means``, ``<name> sum`` and ``<name> count`` per category."""
    return df.groupBy(column).agg(*category_aggregates(means))


def overall_means(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with a struct of the columns' means over all categories."""
    cells = [F.try_divide(F.sum(quoted(f"{c} sum")), F.sum(quoted(f"{c} count"))).alias(c) for c in columns]
    return counts.agg(F.struct(*cells).alias("means"))


def group_rare(
    df: DataFrame,
    column: str,
    below: int = fv.RARE_BELOW,
    counts: DataFrame | None = None,
    salt_by: Sequence[str] | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Add ``<column>_grouped``: values with fewer than ``below`` rows in ``counts`` become ``other``; null stays null.

    ``counts`` are by default those of ``df``. Building the frame runs nothing: Spark broadcasts the rare values where
    they turn out to be few, and shuffles else. For that case the rows of a category are dealt into ``salts`` parts by
    the ``salt_by`` columns (by default all), and the rare values, never the hot ones, are copied to each.
    """
    counted = counts if counts is not None else category_counts(df, column)
    rare = counted.filter((F.col("rows") < below) & F.col(column).isNotNull())
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    lookup = rare.select(column, F.lit(True).alias("_rare"), copies)
    salt = F.pmod(F.xxhash64(*(salt_by or df.columns)), F.lit(salts)).cast("int")
    marked = df.withColumn("_salt", salt).join(lookup, [column, "_salt"], "left")
    grouped = F.when(F.col("_rare"), fv.OTHER).otherwise(F.col(column))
    return marked.select(*df.columns, grouped.alias(f"{column}_grouped"))
