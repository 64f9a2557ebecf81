"""Toxicity scores: a weighted lexicon, matched by Aho-Corasick on folded text, with exception phrases."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import pick

FOLDS = 5
TRAINING_ROWS = 20_000
MOST_TERMS = 1_000
LEAST_DOCS = 3
LEAST_Z = 3.0
LEAST_WEIGHT = 1.5
# Words are inflected, so their beginnings of these lengths are candidates too, written with a star
STEMS = (4, 5, 6)
# Letters of other scripts and signs that are read as Latin letters, and digits used for letters
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ε": "e", "ι": "i", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "ν": "v", "κ": "k", "ı": "i", "ł": "l", "ø": "o", "ß": "ss",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}
# Phrases in which a word of the lexicon does not insult
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "sore loser", "pathetic fallacy")
TOKEN = regex.compile(r"[^\W_]+")
_SIGNED = regex.compile(r"(?<=\p{L})[0-9@$!|]+(?=\p{L})|\b[013457]+(?=\p{L})|(?<!\S)[@$]+(?=\p{L})|(?<=\p{L})[013457]+\b")


def _letters() -> dict[int, str]:
    """Lower case without accents for the Latin letters, and the homoglyphs of either case."""
    table = {}
    for code in range(0xC0, 0x250):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code).lower()) if not unicodedata.combining(c))
        table[code] = HOMOGLYPHS.get(plain, plain)
    for odd, plain in HOMOGLYPHS.items():
        table[ord(odd)] = plain
        if len(odd.upper()) == 1:
            table[ord(odd.upper())] = plain
    return table


_LETTERS = _letters()
_SIGN_TABLE = str.maketrans(SIGNS)


def fold(text: str | None) -> str:
    """The words of a text, one blank before, between and after them, in plain lower-case Latin letters.

    Full-width and other compatibility forms and zero-width characters are undone first. Digits and signs count as
    letters only where they touch a letter of the same word.
    """
    text = text or ""
    if not text.isascii():
        if not all(ord(c) < 0x250 for c in set(text)):
            text = unicodedata.normalize("NFKC", text)
            text = regex.sub(r"\p{Cf}", "", text)
        text = text.translate(_LETTERS)
    text = _SIGNED.sub(lambda m: m[0].translate(_SIGN_TABLE), text.lower())
    return f" {' '.join(TOKEN.findall(text))} "


def held_out(key: str = "doc_id"):
    """Whether a row is kept apart from training: its key's checksum is divisible by ``FOLDS``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


@dataclass(frozen=True)
class Model:
    """Weights of lexicon terms, exception phrases, and the logistic curve over (log of weight, weight per word)."""

    terms: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, float, float]


def _matcher(terms: dict[str, float], exceptions: Sequence[str]) -> ahocorasick.Automaton | None:
    machine = ahocorasick.Automaton()
    for phrase, weight in [*terms.items(), *((e, None) for e in exceptions)]:
        stem = phrase.endswith("*")
        machine.add_word(f" {phrase[:-1]}" if stem else f" {phrase} ", (len(phrase) - stem, stem, weight))
    if not len(machine):
        return None
    machine.make_automaton()
    return machine


def match_weight(machine: ahocorasick.Automaton | None, folded: str) -> float:
    """The summed weights of the terms found: the largest one at each word, none inside an exception phrase."""
    if machine is None:
        return 0.0
    found: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for end, (length, stem, weight) in machine.iter(folded):
        start = end - length + stem
        if weight is None:
            excused.append((start, end))
        else:
            found[start] = max(weight, found.get(start, 0.0))
    return sum(w for at, w in found.items() if not any(a <= at < b for a, b in excused))


def _features(weight: float, n_words: int) -> tuple[float, float]:
    """Insults as such, and per hundred words: length-normalised, but one in a very long text still counts."""
    return float(np.log1p(weight)), 100.0 * weight / (n_words + 50)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge."""
    design = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(3), np.diag([1e-3, 1e-1, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve(design.T * (p * (1 - p)) @ design + ridge, design.T @ (y - p) - ridge @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def _folded_words(narrow: DataFrame) -> DataFrame:
    """(toxic, word) for every different folded word and stem of a text, and one null word for each text."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for text, toxic in zip(frame["text"], frame["toxic"].to_pylist(), strict=True):
                whole = set(fold(text.as_py()).split())
                unique = [None, *whole, *{f"{w[:n]}*" for w in whole for n in STEMS if len(w) > n}]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([toxic] * len(unique), pa.int32()), pa.array(unique, pa.string())], names=["toxic", "word"]
                )

    return narrow.select("text", "toxic").mapInArrow(batches, "toxic int, word string")


def _matched(narrow: DataFrame, terms: dict[str, float], exceptions: Sequence[str]) -> DataFrame:
    """The two features of every text; all columns but the text pass through."""
    others = [c for c in narrow.columns if c != "text"]

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _matcher(terms, exceptions)
        for frame in frames:
            rows = [fold(t.as_py()) for t in frame["text"]]
            found = np.array([_features(match_weight(machine, r), r.count(" ") - 1) for r in rows]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*[frame[c] for c in others], pa.array(found[:, 0]), pa.array(found[:, 1])],
                names=[*others, "total", "density"],
            )

    passed = ", ".join(f"{c} {t}" for c, t in narrow.dtypes if c != "text")
    return narrow.mapInArrow(batches, f"{passed}, total double, density double")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    rows: int = TRAINING_ROWS,
    exceptions: Sequence[str] = EXCEPTIONS,
    most_terms: int = MOST_TERMS,
) -> Model:
    """A lexicon and a curve from at most ``rows`` labelled texts that are not held out, the first by a hash.

    The weight of a word or stem is its smoothed log odds of being in a toxic text against any other; it is in the
    lexicon if at least ``LEAST_DOCS`` toxic texts have it and the weight is ``LEAST_Z`` standard errors or more. The
    driver sees at most ``most_terms`` words and ``rows`` pairs of numbers. Without labels of both kinds nothing
    matches and every text scores 0.
    """
    labelled = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
    sample = labelled.agg(F.max("toxic").cast("int").alias("toxic")).filter(~held_out())
    sample = F.broadcast(sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    training = pick(docs, doc_id=key, text=text).join(sample, "doc_id").select("text", "toxic")
    counts = _folded_words(training).groupBy("word").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("n")
    )
    totals = counts.filter(F.col("word").isNull()).first()
    if not totals or not totals["t"] or not totals["n"]:
        return Model({}, tuple(exceptions), (-30.0, 0.0, 0.0))
    t, n = F.col("t"), F.col("n")
    odds = lambda x, total: F.log((x + 0.5) / (total - x + 0.5))
    weight = odds(t, totals["t"]) - odds(n, totals["n"])
    error = F.sqrt(1 / (t + 0.5) + 1 / (totals["t"] - t + 0.5) + 1 / (n + 0.5) + 1 / (totals["n"] - n + 0.5))
    judged = counts.filter(F.col("word").isNotNull() & (t >= LEAST_DOCS) & (F.length("word") > 2))
    judged = judged.withColumns({"weight": weight, "z": weight / error})
    strong = judged.filter((F.col("z") >= LEAST_Z) & (F.col("weight") >= LEAST_WEIGHT))
    terms = {r["word"]: float(r["weight"]) for r in strong.orderBy(F.desc("z"), "word").limit(most_terms).collect()}
    seen = _matched(training, terms, exceptions).select("toxic", "total", "density").toArrow()
    x = np.column_stack([seen["total"].to_numpy(), seen["density"].to_numpy()])
    return Model(terms, tuple(exceptions), _curve(x, seen["toxic"].to_numpy()))


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, score, predicted) for every row: how likely its text is toxic, from the text alone.

    Null and empty texts match nothing and get the curve's least score. Repeated rows give repeated rows.
    """
    bias, of_total, of_density = model.curve
    found = _matched(pick(docs, doc_id=key, text=text), model.terms, model.exceptions)
    logit = bias + of_total * F.col("total") + of_density * F.col("density")
    likely = 1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(30.0)), F.lit(-30.0))))
    return found.select("doc_id", likely.alias("score"), (likely >= 0.5).cast("int").alias("predicted"))
