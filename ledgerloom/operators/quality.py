"""Data-quality reports as DataFrames.

Every report is one aggregation over the table, whatever the number of columns, so a table is scanned once per report
and only a row per column leaves the aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import fixed_values as fv
from ledgerloom.functions.casting import quoted, without_suffix

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
SKETCH_SIZE = 4096
SKETCH_GROUPS = 256


@dataclass(frozen=True)
class FormatRule:
    """The text format a raw column has to have."""

    column: str
    pattern: str
    allow_suffix: bool = False

    def broken(self) -> str:
        """SQL that is true for a badly formatted value and null for a null one."""
        text = without_suffix(self.column) if self.allow_suffix else quoted(self.column)
        return f"NOT {text} RLIKE r'{self.pattern}'"


def rules_for(columns: Iterable[str], pattern: str, allow_suffix: bool = False) -> list[FormatRule]:
    return [FormatRule(c, pattern, allow_suffix) for c in columns]


def _one_row_per_column(
    df: DataFrame, columns: Iterable[str], measures: Callable[[str], Mapping[str, str]]
) -> DataFrame:
    """Aggregate the SQL ``measures`` of every column in one pass, then turn the single row into one per column."""

    def aggregates(column: str) -> str:
        named = [f"{sql} AS {quoted(name)}" for name, sql in measures(column).items()]
        return f"struct('{column}' AS `column`, {', '.join(named)})"

    return df.agg(F.expr(f"array({', '.join(map(aggregates, columns))})").alias("rows")).select(F.inline("rows"))


def invalid_counts(df: DataFrame, rules: Sequence[FormatRule]) -> DataFrame:
    """(column, invalid): badly formatted values per column; nulls are not counted."""
    broken = {r.column: r.broken() for r in rules}
    return _one_row_per_column(df, broken, lambda c: {"invalid": f"count_if({broken[c]})"})


def invalid_summary(df: DataFrame, rules: Sequence[FormatRule]) -> DataFrame:
    """Only the columns that have badly formatted values."""
    return invalid_counts(df, rules).filter("invalid > 0")


def invalid_samples(df: DataFrame, rules: Sequence[FormatRule], key: str = fv.CUSTOMER, size: int = 3) -> DataFrame:
    """(column, key, value): the first ``size`` bad values of each column, in key and value order.

    Only bad cells are emitted, and the rank filter lets Spark cut each task's rows to ``size`` before it shuffles.
    """
    cells = [
        f"if({r.broken()}, struct('{r.column}' AS `column`, {quoted(key)}, {quoted(r.column)} AS value), NULL)"
        for r in rules
    ]
    bad = df.select(F.expr(f"inline(array_compact(array({', '.join(cells)})))"))
    in_order = Window.partitionBy("column").orderBy(key, "value")
    return bad.withColumn("position", F.row_number().over(in_order)).filter(F.col("position") <= size)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls)."""
    return _one_row_per_column(df, columns or df.columns, lambda c: {"nulls": f"count_if({quoted(c)} IS NULL)"})


def null_bearing(df: DataFrame) -> DataFrame:
    """Columns, flags apart, that hold at least one null."""
    return null_profile(df, [c for c in df.columns if "flag" not in c.lower()]).filter("nulls > 0")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(total_rows, distinct_keys, duplicate_rows). A null key is a value like any other."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def _extreme(function: str, column: str) -> str:
    return f"CAST({function}({quoted(column)}) AS DOUBLE)"


def range_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, min, max, mean) as doubles."""
    return _one_row_per_column(
        df, columns, lambda c: {"min": _extreme("min", c), "max": _extreme("max", c), "mean": f"avg({quoted(c)})"}
    )


def numeric_columns(df: DataFrame, but: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.IntegerType)) and f.name not in but
    ]


def feature_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, stddev, min, max)."""
    return _one_row_per_column(
        df,
        columns,
        lambda c: {
            "count": f"count({quoted(c)})",
            "mean": f"avg({quoted(c)})",
            "stddev": f"stddev({quoted(c)})",
            "min": _extreme("min", c),
            "max": _extreme("max", c),
        },
    )


def feature_quartiles(df: DataFrame, columns: Sequence[str], k: int = SKETCH_SIZE) -> DataFrame:
    """(column, p25, p50, p75) from mergeable sketches, off by about ``2.4 / k ** 0.94`` of the rows.

    Each task makes a sketch per column. They are merged in SKETCH_GROUPS groups first, so that the last task gets that
    many sketches and not one from every task.
    """

    def of_all(make: Callable[[str], str]) -> list[str]:
        return [f"{make(quoted(c))} AS {quoted(c)}" for c in columns]

    def quantile(c: str, q: float) -> str:
        return f"if(kll_sketch_get_n_double({c}) > 0, kll_sketch_get_quantile_double({c}, {q}D), NULL)"

    def measured(c: str) -> str:
        names = ", ".join(f"{quantile(quoted(c), q)} AS {name}" for name, q in QUARTILES.items())
        return f"struct('{c}' AS `column`, {names})"

    grouped = df.selectExpr(*of_all(lambda c: f"CAST({c} AS DOUBLE)")).groupBy(
        F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")
    )
    partial = grouped.agg(*map(F.expr, of_all(lambda c: f"kll_sketch_agg_double({c}, {k})")))
    whole = partial.agg(*map(F.expr, of_all(lambda c: f"kll_merge_agg_double({c}, {k})")))
    return whole.selectExpr(f"inline(array({', '.join(map(measured, columns))}))")


def feature_summary(df: DataFrame, columns: Sequence[str], k: int = SKETCH_SIZE) -> DataFrame:
    """(column, count, mean, stddev, min, max, p25, p50, p75): a row per feature, all from one scan.

    Moments and sketches are made in SKETCH_GROUPS groups and then merged, the moments pairwise, so that a small spread
    around a large mean is not lost.
    """
    parts = {
        "n": "count({0})",
        "mean": "avg({0})",
        "m2": "var_pop({0}) * count({0})",
        "low": "min({0})",
        "high": "max({0})",
        "sketch": f"kll_sketch_agg_double({{0}}, {k})",
    }
    zero = "named_struct('n', 0L, 'mean', 0D, 'm2', 0D)"
    merge = """(a, b) -> if(b.n = 0, a, named_struct('n', a.n + b.n,
        'mean', a.mean + (b.mean - a.mean) * b.n / (a.n + b.n),
        'm2', a.m2 + b.m2 + (b.mean - a.mean) * (b.mean - a.mean) * a.n * b.n / (a.n + b.n)))"""

    def whole(c: str) -> str:
        n, mean, m2, low, high, sketch = (quoted(f"{c} {part}") for part in parts)
        listed = f"collect_list(named_struct('n', {n}, 'mean', coalesce({mean}, 0D), 'm2', coalesce({m2}, 0D)))"
        quartiles = ", ".join(
            f"'{name}', if(sum({n}) > 0, kll_sketch_get_quantile_double(kll_merge_agg_double({sketch}, {k}), {q}D), NULL)"
            for name, q in QUARTILES.items()
        )
        return f"""named_struct('column', '{c}', 'of', aggregate({listed}, {zero}, {merge}),
            'min', min({low}), 'max', max({high}), {quartiles})"""

    cast = df.selectExpr(*[f"CAST({quoted(c)} AS DOUBLE) AS {quoted(c)}" for c in columns])
    grouped = cast.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group"))
    partial = grouped.agg(
        *[F.expr(sql.format(quoted(c))).alias(f"{c} {part}") for c in columns for part, sql in parts.items()]
    )
    merged = partial.agg(F.expr(f"array({', '.join(map(whole, columns))})").alias("rows")).select(F.inline("rows"))
    return merged.selectExpr(
        "`column`",
        "of.n AS count",
        "if(of.n > 0, of.mean, NULL) AS mean",
        "if(of.n > 1, sqrt(of.m2 / (of.n - 1)), NULL) AS stddev",
        "min",
        "max",
        *QUARTILES,
    )


def quartile_ranks(df: DataFrame, columns: Sequence[str], k: int = SKETCH_SIZE) -> DataFrame:
    """(column, quartile, count, within): whether each quartile of ``feature_quartiles`` has the rank it should have.

    The rows below it and at it are counted exactly; ``within`` is true where its rank is off by no more than the
    sketches' bound, or where there is no value at all.
    """
    quartiles = feature_quartiles(df, columns, k)
    named = F.map_from_entries(F.collect_list(F.struct("column", F.array(*QUARTILES))))
    found = df.select(*columns).withColumn("_q", quartiles.agg(named).scalar())
    bound = 2.4 / k**0.94

    def measured(c: str) -> dict[str, str]:
        cells = {"count": f"count({quoted(c)})"}
        for i, name in enumerate(QUARTILES):
            at = f"CAST({quoted(c)} AS DOUBLE) {{}} _q['{c}'][{i}]"
            cells |= {f"below_{name}": f"count_if({at.format('<')})", f"upto_{name}": f"count_if({at.format('<=')})"}
        return cells

    counted = _one_row_per_column(found, columns, measured)
    rows = ", ".join(
        f"struct('{name}' AS quartile, count = 0 OR (below_{name} <= ({q} + {bound}) * count + 1"
        f" AND upto_{name} >= ({q} - {bound}) * count - 1) AS within)"
        for name, q in QUARTILES.items()
    )
    return counted.selectExpr("`column`", "count", f"inline(array({rows}))")


def flag_totals(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """One row with the sum of every flag."""
    return df.agg(*[F.sum(f).alias(f) for f in flags])


def value_distribution(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(flag, value, rows, pct). Rows are counted per combination first, so only combinations are unpivoted."""
    combos = df.groupBy(*flags).agg(F.count(F.lit(1)).alias("n"))
    cells = combos.unpivot(["n"], list(flags), "flag", "value")
    counts = cells.groupBy("flag", "value").agg(F.sum("n").alias("rows"))
    return counts.withColumn("pct", F.expr("100.0D * rows / sum(rows) OVER (PARTITION BY flag)"))


def flag_rates(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(condition, hits, total, rate) of 0/1 columns; the rate of an empty table is null."""
    counted = _one_row_per_column(df, flags, lambda c: {"hits": f"count_if({quoted(c)} = 1)", "total": "count(1)"})
    return counted.withColumnRenamed("column", "condition").withColumn("rate", F.expr("try_divide(hits, total)"))


def column_kinds(df: DataFrame, prefix: str = "fe_") -> dict[str, int]:
    """How many feature, raw and outlier columns a click-stream gold table has; needs no job."""
    raw = [c for c in df.columns if c.endswith("_raw")]
    outlier = [c for c in df.columns if c.endswith("_is_outlier")]
    features = [c for c in df.columns if c.startswith(prefix) and c not in {*raw, *outlier}]
    return {"features": len(features), "raw_values": len(raw), "outlier_flags": len(outlier)}


def table_shape(df: DataFrame) -> DataFrame:
    """One row: the row count and the column kinds."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), *[F.lit(n).alias(kind) for kind, n in column_kinds(df).items()]
    )


def label_report(labels: DataFrame) -> DataFrame:
    """(snapshot_date, label_def, loans, defaults)."""
    return labels.groupBy(fv.SNAPSHOT, "label_def").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("label").alias("defaults")
    )
