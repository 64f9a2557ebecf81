"""Phrase collocations by stripes: every prefix keys a counter of its next words, merged element by element."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import batches
from ledgerloom.llm.text import pick
from ledgerloom.sources.scratch import stored

LONGEST = 5
LEAST_COUNT = 100
FIRST = 2000
# Bits a frequent phrase gets in the bitmap that prunes the next pass, and the most bits of a bitmap (32 MB)
BITS_EACH = 16
MOST_BITS = 1 << 28
# A prefix with more than one in HOT_SHARE of all words is hot: at most HOT_SHARE are. Its stripe is dealt by next word
HOT_SHARE = 1000
HOT_PARTS = 64
ROOT_PARTS = 256

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_STRIPES = "lang string, prefix string, part int, stripe array<struct<next: string, n: bigint>>"
_ARROW = pa.schema(
    [
        ("lang", pa.string()),
        ("prefix", pa.string()),
        ("part", pa.int32()),
        ("stripe", pa.list_(pa.struct([("next", pa.string()), ("n", pa.int64())]))),
    ]
)


class Words:
    """The words of a batch: local numbers, hashes, languages, and how many words of its piece follow each."""

    def __init__(self, frame: pa.RecordBatch) -> None:
        texts = batches.text_column(frame["text"])
        raw, bounds = batches.raw_bytes(texts)
        kind = _KIND[raw]
        is_word = kind == 0
        starts, ends = batches.word_spans(is_word, bounds)
        self.ids, self.words = batches.encoded(_LOWER[raw], is_word, starts, ends)
        self.hashes = batches.word_hashes(self.words)
        doc = np.searchsorted(bounds, starts, side="right") - 1
        breaks = np.searchsorted(np.flatnonzero(kind == 2), starts)
        langs = pc.fill_null(frame["lang"].cast(pa.string()), "und").dictionary_encode()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy()[doc]
        new = np.ones(len(starts) + 1, bool)
        if len(starts):
            new[1:-1] = (doc[1:] != doc[:-1]) | (breaks[1:] != breaks[:-1])
        of_piece = np.flatnonzero(new)
        self.left = np.repeat(of_piece[1:], np.diff(of_piece)) - np.arange(len(starts))

    def phrase_hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of (lang, phrase) for the phrases of ``size`` words at the places ``at``."""
        of_lang = batches.word_hashes(self.langs.cast(pa.binary()))
        found = of_lang[self.lang[at]]
        for k in range(size):
            found = batches.chained(found, self.hashes[self.ids[at + k]])
        return found


def _stripes_of(words: Words, size: int, bitmap: np.ndarray | None, hot: np.ndarray) -> pa.RecordBatch:
    """The stripes of all prefixes of ``size - 1`` words, without extensions that cannot be frequent."""
    at = np.flatnonzero(words.left >= size)
    before = words.phrase_hashes(at, size - 1)
    if bitmap is not None and len(at):
        after = words.phrase_hashes(at + 1, size - 1)
        possible = _marked(bitmap, before) & _marked(bitmap, after)
        at, before = at[possible], before[possible]
    group = words.lang[at].astype(np.int64)
    for k in range(size - 1):
        _, group = np.unique(group * len(words.words) + words.ids[at + k], return_inverse=True)
    last = words.ids[at + size - 1]
    _, where, n = np.unique(group * len(words.words) + last, return_index=True, return_counts=True)
    parts = ROOT_PARTS if size == 1 else HOT_PARTS
    dealt = np.isin(before[where], hot) if size > 1 else np.ones(len(where), bool)
    part = np.where(dealt, words.hashes[last[where]] % np.uint64(parts), 0).astype(np.int32)
    order = np.lexsort((part, group[where]))
    where, n, part, group = where[order], n[order], part[order], group[where][order]
    new = np.ones(len(where), bool)
    new[1:] = (group[1:] != group[:-1]) | (part[1:] != part[:-1])
    begins = np.flatnonzero(new)
    first = at[where[begins]]
    text = words.words.cast(pa.large_string())
    cells = [text.take(pa.array(words.ids[first + k])) for k in range(size - 1)]
    prefix = pc.binary_join_element_wise(*cells, pa.scalar(" ", pa.large_string())) if cells else pa.array([""] * len(first))
    entries = pa.StructArray.from_arrays(
        [text.take(pa.array(last[where])).cast(pa.string()), pa.array(n.astype(np.int64))], names=["next", "n"]
    )
    offsets = pa.array(np.append(begins, len(where)).astype(np.int32))
    columns = [
        words.langs.take(pa.array(words.lang[first])),
        prefix.cast(pa.string()),
        pa.array(part[begins]),
        pa.ListArray.from_arrays(offsets, entries),
    ]
    return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, _ARROW.types, strict=True)], schema=_ARROW)


def _totals_of(words: Words) -> pa.RecordBatch:
    """How many words each language has, as stripes of the root with an extension that is no word."""
    n = np.bincount(words.lang, minlength=len(words.langs))
    entries = pa.StructArray.from_arrays([pa.nulls(len(n), pa.string()), pa.array(n.astype(np.int64))], names=["next", "n"])
    offsets = pa.array(np.arange(len(n) + 1, dtype=np.int32))
    columns = [words.langs, pa.array([""] * len(n)), pa.array([0] * len(n)), pa.ListArray.from_arrays(offsets, entries)]
    return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, _ARROW.types, strict=True)], schema=_ARROW)


def _marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def stripes(docs: DataFrame, size: int, bitmap: bytes | None = None, hot: np.ndarray | None = None) -> DataFrame:
    """(lang, prefix, part, stripe) of every batch of (text, lang) rows, for phrases of ``size`` words."""
    known = np.empty(0, np.uint64) if hot is None else hot

    def counted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = None if bitmap is None else np.frombuffer(bitmap, np.uint8)
        for frame in batches.sliced(frames):
            words = Words(frame)
            if size == 1:
                yield _totals_of(words)
            if len(words.ids):
                yield _stripes_of(words, size, marks, known)

    return docs.mapInArrow(counted, _STRIPES)


def merged(found: DataFrame) -> DataFrame:
    """(lang, prefix, next, n): stripes added up element by element, in the task that a prefix's part goes to."""
    dealt = found.repartition("lang", "prefix", "part").select("lang", "prefix", "part", F.inline("stripe"))
    return dealt.groupBy("lang", "prefix", "part", "next").agg(F.sum("n").alias("n")).drop("part")


def phrase(prefix: Column, following: Column) -> Column:
    return F.when(prefix == "", following).otherwise(F.concat_ws(" ", prefix, following))


def _hashed(entries: DataFrame) -> DataFrame:
    """(h, n) of the phrases of merged stripes, hashed as the batches hash theirs."""

    def hashes(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            h = np.zeros(len(frame), np.uint64)
            for i, (lang, text) in enumerate(zip(frame["lang"].to_pylist(), frame["phrase"].to_pylist(), strict=True)):
                of = batches.word_hashes(pa.array([lang.encode(), *(w.encode() for w in text.split(" "))], pa.binary()))
                one = of[:1]
                for k in range(1, len(of)):
                    one = batches.chained(one, of[k : k + 1])
                h[i] = one[0]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), frame["n"]], names=["h", "n"])

    return entries.select("lang", phrase(F.col("prefix"), F.col("next")).alias("phrase"), "n").mapInArrow(hashes, "h long, n long")


def _pruning(entries: DataFrame, total: int) -> tuple[bytes, np.ndarray]:
    """A bitmap of the frequent phrases, MOST_BITS at most, and the hashes of the hot ones, HOT_SHARE at most."""
    marked = stored(_hashed(entries), "phrase-hashes")
    size, bits = marked.count(), 1 << 13
    while bits < min(size * BITS_EACH, MOST_BITS):
        bits *= 2
    place = F.col("h").bitwiseAND(F.lit(bits - 1))
    cell = F.shiftright(place, 6).alias("cell")
    mark = F.expr("shiftleft(1L, CAST(h & 63 AS INT))")
    cells = marked.groupBy(cell).agg(F.bit_or(mark).alias("marks")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[cells["cell"].to_numpy()] = cells["marks"].to_numpy()
    hot = marked.filter(F.col("n") * HOT_SHARE > total).select("h").toArrow()["h"].to_numpy().view(np.uint64)
    return bitmap.astype("<i8").tobytes(), np.sort(hot)


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST_COUNT,
    longest: int = LONGEST,
    first: int | None = FIRST,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases whose parts meet more often than chance has it.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces, and these at blanks and tabs into words.
    A candidate has two to ``longest`` words and occurs ``a >= least`` times within pieces. Of its cuts into ``l`` and
    ``r`` occurrences of the parts the one with the least ``floor(1000 * a * n / (l * r))`` is its score. Candidates that
    never occur but inside one longer candidate go. Of each language the ``first`` come back (all if None).

    One pass over the texts for each length. A task counts its batches into stripes; a prefix's stripe goes to one task
    and is added up there. Each part of a frequent phrase is frequent itself, so a pass leaves out extensions whose two
    shorter phrases are not in the bitmap of frequent ones; that its bits can be shared costs rows, not results. The
    stripe of a hot prefix is dealt over tasks by its next words. All later steps read the merged stripes: extensions
    are their entries, the total of a prefix is its entry one length below, and the largest extension to the right or
    left is a maximum over entries.

    Null texts are empty, null languages ``und``; repeated rows count again; empty tables give no rows.
    """
    rows = pick(docs, text=text, lang=lang)
    found = stored(merged(stripes(rows, 1)), "words")
    totals = found.filter(F.col("next").isNull()).select("lang", F.col("n").alias("total"))
    total = found.agg(F.sum(F.when(F.col("next").isNull(), F.col("n")))).first()[0] or 0
    levels = [found.filter(F.col("next").isNotNull() & (F.col("n") >= least))]
    for size in range(2, longest + 1):
        bitmap, hot = _pruning(levels[-1], total)
        grown = merged(stripes(rows, size, bitmap, hot)).filter(F.col("n") >= least)
        levels.append(stored(grown, f"phrases-{size}"))
    return _ranked(levels, totals, first)


def _ranked(levels: list[DataFrame], totals: DataFrame, first: int | None) -> DataFrame:
    sized = [
        x.select("lang", "prefix", phrase(F.col("prefix"), F.col("next")).alias("phrase"), F.lit(k).alias("size"), "n")
        for k, x in enumerate(levels, 1)
    ]
    counts = stored(reduce(DataFrame.unionByName, sized), "counts")
    longer = counts.filter("size > 2")
    rest = F.expr("substring(phrase, locate(' ', phrase) + 1)")
    extended = longer.select("lang", F.col("prefix").alias("phrase"), "n").unionByName(
        longer.select("lang", rest.alias("phrase"), "n")
    )
    largest = extended.groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    kept = (
        counts.filter("size > 1")
        .join(largest, ["lang", "phrase"], "left")
        .filter("most IS NULL OR most < n")
        .select("lang", "phrase", "size", F.col("n").alias("a"))
    )
    words = F.split("phrase", " ", -1)
    cut = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).withColumns(
        {
            "head": F.array_join(F.slice(words, 1, F.col("k")), " "),
            "tail": F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " "),
        }
    )
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    wide = {c: f"CAST({c} AS DECIMAL(19, 0))" for c in ("a", "l", "r", "total")}
    score = F.expr(f"(({wide['a']} * {wide['total']}) * 1000BD) div ({wide['l']} * {wide['r']})")
    scored = cut.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang").withColumn("score", score)
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("low")
    best = scored.groupBy("lang", "phrase").agg(lowest, F.first("a").alias("a"), F.first("total").alias("n"))
    flat = best.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = flat.withColumn("rank", F.row_number().over(order))
    if first is not None:
        ranked = ranked.filter(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
