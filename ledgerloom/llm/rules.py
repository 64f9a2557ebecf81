"""Quality rules: base counts of a text and a hashed n-gram likelihood ratio of trusted against all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import BLANKS, let, pick, positions, window_hashes, words
from ledgerloom.sources.scratch import stored

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 20
REPEAT_WINDOW = 8
MOST_REPEATED_PERCENT = 30
BUCKETS = 10_000
# As many trusted doc_ids are copied to all tasks; more of them meet their texts in a shuffle
BROADCAST_IDS = 1_000_000
LEAST_RATIO = -0.5
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept")
_RATIOS, _VERDICT = "__ratios", "__verdict"


def repeated_words(items: Column, width: int = REPEAT_WINDOW) -> Column:
    """Elements that lie in a ``width``-element window found twice or more in the array, the first one included."""

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts, lambda s, i: F.least(F.lit(width), F.coalesce(F.get(starts, i + 1) - s, F.lit(width)))
        )
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def twins(ranked: Column) -> Column:
        marked = F.transform(
            ranked,
            lambda x, i: F.when(
                x["h"].eqNullSafe(F.get(ranked, i - 1)["h"]) | x["h"].eqNullSafe(F.get(ranked, i + 1)["h"]), x["at"]
            ),
        )
        return let(F.sort_array(F.array_compact(marked)), covered)

    def counted(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(ranked, twins))

    return let(F.transform(items, lambda w: F.xxhash64(w)), lambda h: let(window_hashes(h, width), counted))


def edge_grams(items: Column, buckets: int) -> Column:
    """Hashed character n-grams at word edges: each word's last three characters, and two and two across each gap.

    They tell script, case, punctuation and symbols apart and are dense however many different words a corpus has.
    """
    ends = F.transform(items, lambda w: F.pmod(F.xxhash64(F.right(w, F.lit(3))), F.lit(buckets)))
    gaps = F.transform(
        positions(0, F.size(items) - 2),
        lambda i: F.pmod(
            F.xxhash64(F.right(F.get(items, i), F.lit(2)), F.left(F.get(items, i + 1), F.lit(2))), F.lit(buckets)
        ),
    )
    return F.concat(ends, gaps)


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: ``ratios``, an array over buckets of ln p(bucket | trusted) - ln p(bucket | all).

    Trusted counts are scaled to the size of the whole before one is added to either, so a small trusted part does not
    look different only for being small.

    ``docs`` has (doc_id, text) and counts as a whole; ``trusted`` has different doc_ids, any number of them, by which the
    trusted multinomial is taken from the same pass. What is gathered has one number per bucket.
    """
    named = stored(trusted, "trusted-ids")
    few = named.count() <= BROADCAST_IDS
    named = named.withColumn("trusted", F.lit(True))
    marked = docs.join(F.broadcast(named) if few else named.hint("shuffle_merge"), "doc_id", "left")
    grams = marked.select(
        F.col("trusted"), F.explode(let(words(F.col("text")), lambda w: edge_grams(w, buckets))).alias("bucket")
    )
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count("trusted").alias("t"))
    every = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket")).join(counts, "bucket", "left")
    filled = every.select("bucket", *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in ("n", "t")])
    gathered = filled.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "n", "t"))).alias("all"),
        F.sum("n").alias("sum_n"),
        F.sum("t").alias("sum_t"),
    )
    ratio = lambda x: F.ln((x["t"] * F.col("sum_n") / F.col("sum_t") + 1) / (x["n"] + 1))
    # Without a trusted text nothing can be held against a document
    known = F.when(F.col("sum_t") > 0, F.transform("all", ratio))
    return gathered.select(F.coalesce(known, F.transform("all", lambda x: F.lit(0.0))).alias("ratios"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The different doc_ids labelled as good, all of them."""
    return labels.filter(F.col("quality") == 1).select("doc_id").dropna().distinct()


def judge(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    least_ratio: float = LEAST_RATIO,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Base counts, ratio and verdict of every row of ``docs``; its other columns pass through.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio (mean log-likelihood ratio of
    the text's n-grams, 0 without any) and kept. ``kept`` is false where base_failed or the ratio is below
    ``least_ratio``. ``labels`` (doc_id, quality) names the trusted texts.

    Null texts count as empty and fail; every input row gives one output row, repeated ones too; a column of ``docs``
    with the name of an added one is replaced. Without trusted texts only the base decides.
    """
    judged = _judged(docs, labels, text, key, least_ratio, buckets)
    return judged.withColumns({c: F.col(f"{_VERDICT}.{c}") for c in ADDED}).drop(_VERDICT)


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns only."""
    judged = _judged(docs, labels, text, key, LEAST_RATIO, BUCKETS)
    return judged.filter(F.col(f"{_VERDICT}.kept")).drop(_VERDICT)


def _judged(docs: DataFrame, labels: DataFrame, text: str, key: str, least_ratio: float, buckets: int) -> DataFrame:
    ratios = log_ratios(pick(docs, doc_id=key, text=text), trusted_ids(labels), buckets).scalar()
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        grams = edge_grams(w, buckets)
        total = F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(F.col(_RATIOS), g.cast("int")))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            F.when(F.size(w) > 0, total / (2 * F.size(w) - 1)).otherwise(F.lit(0.0)).alias("ratio"),
        )

    def verdict(of: Column) -> Column:
        n, repeats = of["n_words"], of["n_repeat_words"]
        failed = (n < LEAST_WORDS) | (100 * repeats > MOST_REPEATED_PERCENT * n)
        return F.struct(
            n.alias("n_words"),
            F.length(F.regexp_replace(whole, BLANKS, "")).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeats.alias("n_repeat_words"),
            failed.alias("base_failed"),
            of["ratio"].alias("ratio"),
            (~failed & (of["ratio"] >= least_ratio)).alias("kept"),
        )

    measured = docs.withColumn(_RATIOS, ratios).withColumn(_VERDICT, let(let(words(whole), of_words), verdict))
    return measured.drop(_RATIOS)
