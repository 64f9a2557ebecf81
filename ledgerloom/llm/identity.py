"""Which row a finding belongs to: its key and its text together, as keys can be null or shared by different texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import pick
from ledgerloom.sources.scratch import stored


def digests(key: Column, text: Column) -> dict[str, Column]:
    """h1 and h2: 128 bits of a row's key and text, never null and equal for repeated rows only."""
    return {
        name: F.xxhash64(F.lit(name), key.isNull(), key, text.isNull(), text) for name in ("h1", "h2")
    }


def row_identity(key: Column, text: Column) -> Column:
    """(last, key, h1, h2): equal for repeated rows only, ordered by key, null last, then by digest."""
    both = digests(key, text)
    return F.struct(key.isNull().alias("last"), key.alias("key"), *[h.alias(name) for name, h in both.items()])


def with_row_numbers(docs: DataFrame, text: str = "text", key: str = "doc_id", name: str = "__row") -> DataFrame:
    """``docs`` and a long that is equal for repeated rows only and orders rows by key, null last, then by digest.

    Keys are integers. Where none is null or shared by different texts, a row's number is its key. Otherwise the
    different rows are counted in order: sorted in ranges, counted on from the rows of the ranges before.
    """
    of, content = F.col(f"`{key}`"), F.col(f"`{text}`")
    rows = pick(docs, doc_id=key, text=text)
    marked = rows.select("doc_id", *[h.alias(n) for n, h in digests(F.col("doc_id"), F.col("text")).items()])
    spread = marked.groupBy("doc_id").agg(*[f(h).alias(f"{f.__name__}_{h}") for h in ("h1", "h2") for f in (F.min, F.max)])
    unclear = F.col("doc_id").isNull() | (F.col("min_h1") != F.col("max_h1")) | (F.col("min_h2") != F.col("max_h2"))
    if spread.filter(unclear).isEmpty():
        return docs.withColumn(name, of.cast("long"))
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("h1"), F.col("h2")]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = marked.distinct().repartitionByRange(n, *order).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "row-ranges")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    first = sizes.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    numbers = ranged.withColumn("place", place).join(F.broadcast(first), "part").select(
        F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), (F.col("first") + F.col("place") - 1).cast("long").alias(name)
    )
    numbers = stored(numbers, "row-numbers")
    named = docs.withColumns({f"__{n}": h for n, h in digests(of, content).items()})
    return named.join(numbers, ["__h1", "__h2"]).drop("__h1", "__h2")


def numbered(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, text, row) for every row of ``docs``; ``row`` is the number of ``with_row_numbers``."""
    return pick(with_row_numbers(docs, text, key), doc_id=key, text=text, row="__row")
