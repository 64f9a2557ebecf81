"""Deterministic deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# A number that leads the keys where rows are sorted by them: texts that begin alike are costly to compare
HASH = "_hash"


def with_hash(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(HASH, F.xxhash64(*keys))


def first_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by all other columns in their order, nulls first.

    For a first-row filter Spark already keeps one row per key in each task before it shuffles, so a key that holds a
    third of all rows sends a row per task. The result does not depend on partitioning. Rows of a key are brought
    together ``by`` its hash first, or by the given columns: the keys, with or without their ``HASH``.
    """
    rows = df if by is not None else with_hash(df, keys)
    by = by if by is not None else [HASH, *keys]
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in (*keys, *by)]
    in_order = Window.partitionBy(*by).orderBy(*(rest or keys))
    first = rows.withColumn("_position", F.row_number().over(in_order)).filter("_position = 1")
    return first.select(*[F.col(f"`{c}`") for c in df.columns])
