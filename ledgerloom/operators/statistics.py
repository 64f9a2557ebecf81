"""Whole-table statistics attached to every row.

They come in as a one-row scalar subquery: it runs once ahead of the main stage, needs no join, and keeps the
operators lazy.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.casting import quoted

_STATS = "_stats"


def _one_row(df: DataFrame, aggregates: Iterable[str]) -> DataFrame:
    return df.agg(F.expr(f"struct({', '.join(aggregates)})").alias(_STATS))


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _one_row(
        df, [f"avg({quoted(c)}) AS `{c}_mean`, stddev({quoted(c)}) AS `{c}_stddev`" for c in columns]
    )


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``<column>_mean`` and ``<column>_stddev`` (sample) of every column, in one pass."""
    return _moments(df, columns).select(f"{_STATS}.*")


def clip_sigma(
    df: DataFrame, columns: Sequence[str], sigmas: float = fv.SIGMAS, stats: DataFrame | None = None
) -> DataFrame:
    """Pull values further than ``sigmas`` standard deviations from the mean in to that bound.

    Adds ``<column>_raw`` and ``<column>_is_outlier``. With no spread (one row, or all the same) nothing is flagged.
    The clipped column is always double. ``stats`` is one row with a struct of ``<column>_mean`` and ``<column>_stddev``, by
    default the table's own.
    """

    def bound(c: str, sign: str) -> str:
        return f"({_STATS}.`{c}_mean` {sign} {sigmas}D * nullif({_STATS}.`{c}_stddev`, 0D))"

    def clipped(c: str) -> str:
        within = f"greatest(least(CAST({quoted(c)} AS DOUBLE), {bound(c, '+')}), {bound(c, '-')})"
        return f"if({quoted(c)} IS NULL, NULL, {within}) AS {quoted(c)}"

    def flagged(c: str) -> str:
        within = f"{quoted(c)} BETWEEN {bound(c, '-')} AND {bound(c, '+')}"
        return f"CAST(NOT coalesce({within}, true) AS INT) AS `{c}_is_outlier`"

    kept = [clipped(c) if c in columns else quoted(c) for c in df.columns]
    raw = [f"{quoted(c)} AS `{c}_raw`" for c in columns]
    with_stats = df.withColumn(_STATS, (_moments(df, columns) if stats is None else stats).scalar())
    return with_stats.selectExpr(*kept, *raw, *map(flagged, columns))


def impute_mean(df: DataFrame, columns: Sequence[str], means: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the means of the columns, a struct in one row, by default the table's own. They become double."""
    if means is None:
        means = _one_row(df, [f"avg({quoted(c)}) AS {quoted(c)}" for c in columns])
    filled = [
        f"coalesce(CAST({quoted(c)} AS DOUBLE), {_STATS}.{quoted(c)}) AS {quoted(c)}" if c in columns else quoted(c)
        for c in df.columns
    ]
    return df.withColumn(_STATS, means.scalar()).selectExpr(*filled)
