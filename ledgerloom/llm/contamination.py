"""Benchmark decontamination: a prefix-filtered set join of documents with item-sized windows, verified word by word."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.identity import row_identity
from ledgerloom.llm.text import NOT_PLAIN, ascii_lower, pick, positions
from ledgerloom.sources.scratch import stored

WINDOW = 10
SHINGLE = 5
# Benchmark shingles that one pass over the documents looks for; a larger benchmark takes more passes
BLOCK = 500_000
# Words of a document that are looked at together; pieces overlap by a window at both ends
PIECE = 64


def plain_words(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lowered; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_PLAIN), "")


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, win, size, width, shingles): every window of every item.

    ``win`` has the window's words joined by blanks, ``size`` is how many, ``shingles`` are hashes of its ``width``-word
    shingles in order. An item of fewer words is one window; an item without words has none.
    """
    split = items.select("item_id", plain_words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    sized = split.withColumn("size", F.least(F.lit(window), F.size("w")))
    cut = sized.select("item_id", "w", "size", F.explode(positions(1, F.size("w") - F.col("size") + 1)).alias("at"))
    words = cut.select("item_id", "size", F.slice("w", F.col("at"), F.col("size")).alias("w"))
    width = F.least(F.lit(shingle), F.col("size"))
    hashes = F.transform(positions(1, F.col("size") - width + 1), lambda i: F.xxhash64(F.slice("w", i, width)))
    return words.select("item_id", F.array_join("w", " ").alias("win"), "size", width.alias("width"),
                        hashes.alias("shingles")).distinct()


def _shingle_hashes(w: Column, width: int, first: Column | int = 1, last: Column | None = None) -> Column:
    """Hashes of the ``width``-word shingles that start at the words ``first`` to ``last``, counting from 1."""
    whole = F.size(w) - width + 1
    ends = whole if last is None else F.least(last, whole)
    return F.transform(positions(first, ends), lambda i: F.xxhash64(F.slice(w, i, width)))


def _counts(docs: DataFrame, wanted: DataFrame, widths: list[int]) -> DataFrame:
    """(width, h, n): how often the documents have each wanted shingle that they have at all."""
    split = docs.select(plain_words(F.col("text")).alias("w"))

    def of(width: int) -> DataFrame:
        each = split.select(F.explode(_shingle_hashes(F.col("w"), width)).alias("h"))
        chosen = F.broadcast(wanted.filter(F.col("width") == width).select("h"))
        return each.join(chosen, "h").select(F.lit(width).alias("width"), "h")

    found = reduce(DataFrame.unionByName, [of(k) for k in widths])
    return found.groupBy("width", "h").agg(F.count(F.lit(1)).alias("n"))


def _pieces(docs: DataFrame, margin: int) -> DataFrame:
    """(doc_id, n_words, lead, first, w): the documents' words in pieces of ``PIECE``, with ``margin`` more at both ends.

    ``first`` is where the piece's words start in the document, ``lead`` how many of them belong to the piece before. What
    is made of a shingle copies a piece and never a document, so the work grows with a text's length and not its square.
    """
    split = docs.select("doc_id", plain_words(F.col("text")).alias("w"))
    starts = F.when(F.size("w") > 0, F.sequence(F.lit(0), F.size("w") - 1, F.lit(PIECE))).otherwise(
        F.array().cast("array<int>")
    )

    def piece(at: Column) -> Column:
        lead = F.least(at, F.lit(margin))
        words = F.slice("w", at - lead + 1, lead + F.lit(PIECE + margin))
        return F.struct(lead.alias("lead"), (at - lead).alias("first"), words.alias("w"))

    return split.select("doc_id", F.size("w").alias("n_words"), F.inline(F.transform(starts, piece)))


def _hits(docs: DataFrame, wanted: DataFrame, widths: list[int], window: int) -> DataFrame:
    """(doc_id, at, h, n_words, first, around) wherever a document has a wanted shingle, ``at`` counting from 0.

    ``around`` are the words from ``first`` on that a window with this shingle may cover. Only rows that hit carry them.
    """
    pieces = _pieces(docs, window)

    def of(width: int) -> DataFrame:
        hashes = _shingle_hashes(F.col("w"), width, F.col("lead") + 1, F.col("lead") + PIECE)
        each = pieces.select("doc_id", "n_words", "lead", "first", "w", F.posexplode(hashes).alias("place", "h"))
        chosen = F.broadcast(wanted.filter(F.col("width") == width).select("h"))
        at = F.col("lead") + F.col("place")
        begin = F.greatest(F.lit(0), at - (window - width))
        around = F.slice("w", begin + 1, F.lit(2 * window - width))
        return each.join(chosen, "h").select(
            "doc_id", (F.col("first") + at).alias("at"), "h", F.lit(width).alias("width"), "n_words",
            (F.col("first") + begin).alias("first"), around.alias("around"),
        )

    return reduce(DataFrame.unionByName, [of(k) for k in widths])


def occurrences(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block: int = BLOCK
) -> DataFrame:
    """(doc_id, start, size, item_id): where an item's window occurs in a document, ``start`` counting words from 0.

    A first pass over the documents counts the windows' shingles, by hash alone. A window is contained as a whole only
    where its rarest shingle is, so that one alone is its prefix, and a window with a shingle that no document has goes.
    A second pass looks for prefixes only; a document that has one within the bounds of its position and length is a
    candidate, whose words are then compared one by one. Shingles are broadcast in blocks of a fixed size. Both passes
    take time and memory in proportion to a text's length.
    """
    windows = stored(item_windows(items, window, shingle), "windows")
    wanted = windows.select("width", F.explode("shingles").alias("h")).distinct()
    widths = sorted(r[0] for r in wanted.select("width").distinct().collect())
    if not widths:
        empty = items.select(F.lit(0).alias("start"), F.lit(0).alias("size"), "item_id").limit(0)
        return docs.select("doc_id").limit(0).join(empty, F.lit(False))
    seen = stored(reduce(DataFrame.unionByName, [_counts(docs, b, widths) for b in _blocks(wanted, block)]), "shingle-counts")
    by_place = windows.select("win", "size", "width", F.posexplode("shingles").alias("offset", "h")).distinct()
    ranked = by_place.join(seen, ["width", "h"], "left")
    rarest = ranked.groupBy("win", "size", "width").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "offset")).alias("prefix")
    )
    found = rarest.filter(F.col("prefix.n") > 0)
    needed = stored(found.select("win", "size", "width", "prefix.h", "prefix.offset"), "prefixes")
    prefixes = needed.select("width", "h").distinct()
    hits = reduce(DataFrame.unionByName, [_hits(docs, b, widths, window) for b in _blocks(prefixes, block)])
    start = F.col("at") - F.col("offset")
    fits = (start >= 0) & (start + F.col("size") <= F.col("n_words"))
    met = hits.join(needed, ["width", "h"]).filter(fits)
    same = F.array_join(F.slice("around", start - F.col("first") + 1, F.col("size")), " ") == F.col("win")
    places = met.filter(same).select("doc_id", start.alias("start"), "size", "win")
    return places.join(windows.select("win", "item_id").distinct(), "win").select("doc_id", "start", "size", "item_id")


def _blocks(shingles: DataFrame, block: int) -> list[DataFrame]:
    """The shingles (width, h), stored, in as many parts by hash as bring each to about ``block`` rows."""
    kept = stored(shingles, "wanted")
    blocks = max(1, -(-kept.count() // block))
    return [kept.filter(F.pmod(F.col("h"), F.lit(blocks)) == b) for b in range(blocks)]


def _covered(spans: Column) -> Column:
    """Words that lie in at least one of the sorted (start, size) spans."""

    def step(state: Column, span: Column) -> Column:
        end = span["start"] + span["size"]
        new = F.greatest(F.lit(0), end - F.greatest(span["start"], state["end"]))
        return F.struct((state["n"] + new).alias("n"), F.greatest(end, state["end"]).alias("end"))

    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(spans, zero, step)["n"].cast("long")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids, contaminated) for every row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a window, ``item_ids`` are the items with occurring windows,
    sorted as strings. Null texts have no words and are not contaminated; items that are null or without words match
    nothing, and so does an empty benchmark. Repeated rows give repeated results; different texts under one key, or none,
    are judged apart.
    Items without an id count under the empty name.
    """
    narrow = pick(docs, doc_id=key, text=text).withColumn("row", row_identity(F.col("doc_id"), F.col("text")))
    bench = pick(items, item_id=item_key, text=item_text)
    bench = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    rows = narrow.select(F.col("row").alias("doc_id"), "text")
    found = occurrences(rows, bench, window, shingle, block).groupBy("doc_id").agg(
        F.collect_set(F.struct("start", "size")).alias("spans"), F.collect_set("item_id").alias("items")
    )
    summed = found.select(
        F.col("doc_id.h1").alias("h1"), F.col("doc_id.h2").alias("h2"), _covered(F.sort_array("spans")).alias("hit"), F.sort_array("items").alias("items")
    )
    base = narrow.select("doc_id", "row.h1", "row.h2", F.size(plain_words(F.col("text"))).cast("long").alias("n_words"))
    joined = base.join(summed, ["h1", "h2"], "left")
    n_hit, ids = F.coalesce("hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"),
        (n_hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without any occurrence of an item's window; their columns stay as they are."""
    of = row_identity(F.col(f"`{key}`"), F.col(f"`{text}`"))
    narrow = docs.select(of.alias("doc_id"), F.col(f"`{text}`").alias("text"))
    bench = items.select(F.lit("").alias("item_id"), F.col("text"))
    hit = occurrences(narrow, bench).select(F.col("doc_id.h1").alias("__h1"), F.col("doc_id.h2").alias("__h2")).distinct()
    marked = docs.withColumns({"__h1": of["h1"], "__h2": of["h2"]})
    return marked.join(hit, ["__h1", "__h2"], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
