"""Statistics of a table that grows by snapshots: the state of each snapshot is stored, the whole is merged from these.

A new or changed snapshot is the only one whose rows are looked at; its state replaces the one that was there. Rows
without a snapshot date have a state of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.casting import quoted
from ledgerloom.operators.categories import category_aggregates

OF = "state_of"
UNDATED = "undated"
MOMENTS = f"column string, n long, mean double, m2 double, {OF} string"

_NOTHING = "named_struct('n', 0L, 'mean', 0D, 'm2', 0D)"
# Pairwise, so that a small spread around a large mean is not lost
_MERGE = """(a, b) -> if(b.n = 0, a, named_struct('n', a.n + b.n,
    'mean', a.mean + (b.mean - a.mean) * b.n / (a.n + b.n),
    'm2', a.m2 + b.m2 + (b.mean - a.mean) * (b.mean - a.mean) * a.n * b.n / (a.n + b.n)))"""


def _by_snapshot(df: DataFrame) -> DataFrame:
    return df.withColumn(OF, F.coalesce(F.col(fv.SNAPSHOT).cast("string"), F.lit(UNDATED)))


def moment_state(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n, mean, m2) of every column for each snapshot in ``df``: one aggregate."""

    def measured(c: str) -> str:
        value = f"CAST({quoted(c)} AS DOUBLE)"
        m2 = f"coalesce(var_pop({value}) * count({value}), 0D)"
        return f"struct('{c}' AS `column`, count({value}) AS n, coalesce(avg({value}), 0D) AS mean, {m2} AS m2)"

    cells = F.expr(f"array({', '.join(map(measured, columns))})").alias("cells")
    found = _by_snapshot(df).groupBy(OF).agg(cells).select(OF, F.inline("cells"))
    return found.select("column", "n", "mean", "m2", OF)


def merged_moments(state: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with a struct of ``<column>_mean`` and ``<column>_stddev`` (sample) over all snapshots.

    What meets in a task is one small state per snapshot, merged in the order of the snapshots.
    """
    listed = F.array_sort(F.collect_list(F.struct(OF, "n", "mean", "m2")))
    by_column = state.groupBy("column").agg(listed.alias("parts"))
    whole = by_column.select("column", F.expr(f"aggregate(parts, {_NOTHING}, {_MERGE})").alias("of"))
    valued = whole.selectExpr(
        "`column`", "if(of.n > 0, of.mean, NULL) AS mean", "if(of.n > 1, sqrt(of.m2 / (of.n - 1)), NULL) AS stddev"
    )
    cells = [
        F.max(F.when(F.col("column") == c, F.col(part))).alias(f"{c}_{part}") for c in columns for part in ("mean", "stddev")
    ]
    return valued.agg(*cells).select(F.struct("*").alias("stats"))


def category_state(df: DataFrame, column: str, means: Sequence[str] = ()) -> DataFrame:
    """``category_counts`` for each snapshot in ``df``: one aggregate."""
    return _by_snapshot(df).groupBy(column, OF).agg(*category_aggregates(means))


def merged_categories(state: DataFrame, column: str) -> DataFrame:
    """What ``category_counts`` of all snapshots would be."""
    numbers = [c for c in state.columns if c not in (column, OF)]
    return state.groupBy(column).agg(*[F.sum(quoted(c)).alias(c) for c in numbers])


def write_state(state: DataFrame, path: str) -> None:
    """Store the state of some snapshots, in place of what is stored of the same ones."""
    writer = state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(OF).parquet(path)


def read_state(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The stored state of all snapshots, with the columns of ``like``, which is not run."""
    return spark.read.schema(like.schema).parquet(path).select(*[F.col(quoted(c)) for c in like.columns])
