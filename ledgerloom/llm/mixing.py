"""Mixing sources to target weights by Efraimidis-Spirakis sampling without replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import pick, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
KEY_BUCKETS = 4096
JUNK = "#*$%&|<>0123456789"


def quality_weight(text: Column) -> Column:
    """Between 0.1 and 1: how little of a text is symbols and digits. 1 for empty and null texts."""
    n = F.length(text)
    junk = (n - F.length(F.translate(text, JUNK, ""))) / F.greatest(n, F.lit(1))
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(3.0) * F.coalesce(junk, F.lit(0.0)))


def uniform(key: Column, seed: str = "") -> Column:
    """A number strictly between 0 and 1 that depends on the key alone, so reruns agree."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(2**48)


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = MOST_EPOCHS
) -> DataFrame:
    """(source, source_size, target) from (source, size): one row per source.

    Sources take ``weights`` in turn, by code point, null last. ``share`` of all sizes is dealt out by weight; a target
    stops at ``epochs`` times its source's size and the excess is dealt out again among the others. That ends where
    targets are ``min(epochs * size, level * weight)``, so the sources that stop are the first ones by size per weight.
    What is ordered here has one row per source, not per document.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    dealt = F.get(F.array(*[F.lit(w) for w in weights]), F.col("rank") % len(weights))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("fill"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    weighted = ranked.withColumn("weight", dealt.cast("long")).withColumns(
        {"cap": F.col("source_size") * epochs, "fill": F.col("source_size") * epochs / F.col("weight")}
    )
    run = weighted.withColumns(
        {
            "all_size": F.sum("source_size").over(everything),
            "all_weight": F.sum("weight").over(everything),
            "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    rest = F.col("all_size") * F.lit(share) - F.col("cap_before")
    rest_weight = F.col("all_weight") - F.col("weight_before")
    stops = F.col("cap") * rest_weight <= rest * F.col("weight")
    judged = run.withColumns({"stops": stops, "rest": rest, "rest_weight": rest_weight})
    # The first source that does not stop has what is left to deal out, and the weight of those that share it
    first_open = F.min(F.when(~F.col("stops"), F.struct("fill", "rank", "rest", "rest_weight"))).over(everything)
    shared = judged.withColumn("open", first_open)
    level = F.col("open.rest") * F.col("weight") / F.col("open.rest_weight")
    target = F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(level)
    return shared.select("source", "source_size", target.cast("double").alias("target"))


_GROUP = ("no_source", "of_source", "bucket")


def _mixed(
    rows: DataFrame, weights: Sequence[int], share: float, epochs: int, buckets: int, seed: str
) -> DataFrame:
    """The columns of ``rows`` but its text, with size, source_size, target and taken, one row for each row.

    Whatever else is in ``rows`` (doc_id, text, source) comes along, so no result has to find its row again.
    """
    order = -F.ln(uniform(F.col("doc_id"), seed)) / quality_weight(F.col("text"))

    def sized(df: DataFrame) -> DataFrame:
        """Null-safe group columns that windows and joins share, so that rows are dealt out once."""
        keyed = df.withColumns({"size": word_count(F.col("text")), "order": order}).drop("text")
        # sampling keys are long-tailed where quality is low: this spreads them evenly enough at any quality
        place = F.floor(F.col("order") / (F.col("order") + 1) * buckets).cast("int")
        return keyed.withColumns(
            {"no_source": F.col("source").isNull(), "of_source": F.coalesce("source", F.lit("")), "bucket": place}
        )

    narrow = sized(rows.select("doc_id", "text", "source"))
    targets = source_targets(narrow.select("source", "size"), weights, share, epochs)
    by_bucket = narrow.groupBy(*_GROUP).agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy(*_GROUP[:2]).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_bucket.withColumn("start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0))).drop("bucket_size")
    of_targets = targets.select(
        F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("of_source"), "source_size", "target"
    )
    plan = starts.join(of_targets, list(_GROUP[:2]))
    within = Window.partitionBy(*_GROUP).orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = sized(rows).withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    size, total = F.col("size"), F.col("source_size")
    whole = F.when(total > 0, F.floor(F.col("target") / total)).otherwise(F.lit(0)).cast("long")
    left = F.floor(F.col("target")).cast("long") - whole * total - F.col("start") - F.col("inside")
    taken = (size * whole + F.greatest(F.lit(0), F.least(size, left))).cast("long")
    placed = inside.join(plan, list(_GROUP)).withColumn("taken", taken)
    return placed.drop(*_GROUP, "order", "start", "inside")


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    epochs: int = MOST_EPOCHS,
    buckets: int = KEY_BUCKETS,
    seed: str = "",
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): how many words of each document the mix takes.

    Whole epochs of a source come first. The rest of its target is taken in the order of the sampling keys
    ``-ln(u) / quality``, smallest first, where ``u`` depends on the key column alone; the document that crosses the
    budget gives its leading words only, so each source's taken words are its target, rounded down.

    A source of any size is summed in two steps, so no task has to hold one: keys fall into ``buckets`` ranges, whose
    sums are run up first (sources x buckets rows), and then documents are run up within their range.

    Null and empty texts have size 0 and give 0; null is a source of its own, the last. Repeated rows count as often as
    they are there; equal keys are ordered by size. Without documents there are no rows.
    """
    rows = pick(docs, doc_id=key, text=text, source=source)
    found = _mixed(rows, weights, share, epochs, buckets, seed)
    return found.select("doc_id", "source", "size", "source_size", "target", "taken")


ADDED = ("size", "source_size", "target", "taken")


def taken_documents(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the mix takes words of, with size, source_size, target and taken added.

    Columns of ``docs`` with one of these names are replaced. A row is judged by itself and comes back once at most, also
    where keys are null or shared and where a whole row is repeated.
    """
    plain = docs.drop(*[c for c in ADDED if c in docs.columns])
    whole = F.struct(*[F.col(f"`{c}`") for c in plain.columns]).alias("row")
    named = [F.col(f"`{name}`").alias(alias) for alias, name in (("doc_id", key), ("text", text), ("source", source))]
    found = _mixed(docs.select(*named, whole), WEIGHTS, SHARE, MOST_EPOCHS, KEY_BUCKETS, "").filter(F.col("taken") > 0)
    return found.select("row.*", *ADDED)
