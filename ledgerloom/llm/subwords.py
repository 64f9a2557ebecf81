"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per document, softmax on top.

Next to its words and their n-grams of code points a text has one more feature, the ditto mark, for each word that is
the same as the one before it, and for each three words in a row that the text has had before: an average of vectors
cannot tell otherwise that a text repeats itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import batches
from ledgerloom.llm.text import pick
from ledgerloom.llm.toxicity import held_out

TRAINING_ROWS = 6_000
SIZES = (3, 4)
DITTO_WORDS = 3
BUCKET_BITS = 18
DIMENSIONS = 16
STEPS = 400
BATCH = 32
RATE = 6.0
LEAST_SCORE = 0.3
SEED = 7

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_STEP = np.uint64(0x100000001B3)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
DITTO = 1 << BUCKET_BITS  # the bucket after all hashed ones
_OPEN, _CLOSE = 0x110000, 0x110001  # the ends of a word, beyond all code points


def _buckets(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(31))) * _SPREAD
    return (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


class Features:
    """The words of a batch, and the buckets of every different word and of its n-grams of code points."""

    def __init__(self, frame: pa.RecordBatch) -> None:
        raw, bounds = batches.raw_bytes(batches.text_column(frame["text"]))
        is_word = ~_BLANK[raw]
        starts, ends = batches.word_spans(is_word, bounds)
        self.ids, words = batches.encoded(raw, is_word, starts, ends)
        self.doc = np.searchsorted(bounds, starts, side="right") - 1
        self.n_docs, self.n_words = len(frame), len(words)
        texts = [w.decode("utf-8", "replace") for w in words.to_pylist()]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
        last = np.cumsum(sizes)
        codes = np.empty(int(last[-1]) if len(last) else 0, np.uint64)
        inner = np.ones(len(codes), bool)
        inner[last - 1] = inner[last - sizes] = False
        codes[last - sizes], codes[last - 1] = _OPEN, _CLOSE
        codes[inner] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        of = np.repeat(np.arange(len(texts)), sizes)
        found, owner = [_buckets(batches.word_hashes(words))], [np.arange(len(texts))]
        h = np.zeros(len(codes), np.uint64)
        for n in range(1, max(SIZES) + 1):
            h = (h[: len(codes) - n + 1] + codes[n - 1 :] + np.uint64(1)) * _STEP
            if n in SIZES and len(h):
                whole = of[: len(h)] == of[n - 1 :]
                found.append(_buckets(h[whole] * _SPREAD + np.uint64(n)))
                owner.append(of[: len(h)][whole])
        self.buckets, self.owner = np.concatenate(found), np.concatenate(owner)
        self.dittos = self._repeats(batches.word_hashes(words))

    def _repeats(self, hashes: np.ndarray) -> np.ndarray:
        """For every document how many of its words, and of its runs of DITTO_WORDS words, it has just had or had before."""
        twice = (self.ids[1:] == self.ids[:-1]) & (self.doc[1:] == self.doc[:-1])
        at = np.arange(max(len(self.ids) - DITTO_WORDS + 1, 0))
        at = at[self.doc[at] == self.doc[at + DITTO_WORDS - 1]]
        run = self.doc[at].astype(np.uint64)
        for k in range(DITTO_WORDS):
            run = batches.chained(run, hashes[self.ids[at + k]])
        again = np.ones(len(at), bool)
        again[np.unique(run, return_index=True)[1]] = False
        marked = np.concatenate([self.doc[at[again]], self.doc[1:][twice]])
        return np.bincount(marked, minlength=self.n_docs)

    def sums(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every document the sum of its features' values, and how many features it has."""
        each = np.bincount(self.owner, values[self.buckets], self.n_words)
        count = np.bincount(self.owner, minlength=self.n_words)
        total = np.bincount(self.doc, each[self.ids], self.n_docs) + self.dittos * values[DITTO]
        return total, np.bincount(self.doc, count[self.ids], self.n_docs) + self.dittos

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For every document its different buckets and the share of its features in each."""
        order = np.argsort(self.owner, kind="stable")
        buckets, begin = self.buckets[order], np.searchsorted(self.owner[order], np.arange(self.n_words + 1))
        upto = np.searchsorted(self.doc, np.arange(self.n_docs + 1))
        for a, b, dittos in zip(upto[:-1], upto[1:], self.dittos, strict=True):
            words, times = np.unique(self.ids[a:b], return_counts=True)
            size = begin[words + 1] - begin[words]
            at = np.repeat(begin[words] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            different, where = np.unique(np.append(buckets[at], DITTO), return_inverse=True)
            share = np.bincount(where, np.append(np.repeat(times, size), dittos), len(different))
            yield different.astype(np.int32), (share / max(share.sum(), 1)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """What is left of the vectors for two labels: the output layer is linear, so a bucket's vector counts by how much
    it moves the difference of the two outputs, and an average of vectors by the average of these numbers."""

    values: np.ndarray
    bias: float


def train(labels: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS) -> Model:
    """Bucket vectors and a softmax layer by stochastic gradient descent, the rate falling to zero."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (DITTO + 1, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    target = np.eye(2, dtype=np.float32)[labels]
    order = np.empty(0, np.int64)
    for step in range(steps):
        if len(order) < BATCH:
            order = np.concatenate([order, rng.permutation(len(rows))])
        some, order = order[:BATCH], order[BATCH:]
        rate = np.float32(RATE * (1 - step / steps))
        sizes = [len(rows[i][0]) for i in some]
        of = np.repeat(np.arange(len(some)), sizes)
        buckets = np.concatenate([rows[i][0] for i in some])
        shares = np.concatenate([rows[i][1] for i in some])[:, None]
        mean = np.add.reduceat(vectors[buckets] * shares, np.cumsum(sizes) - sizes)
        logit = mean @ layer + bias
        odds = np.exp(logit - logit.max(axis=1, keepdims=True))
        error = odds / odds.sum(axis=1, keepdims=True) - target[some]
        back = (error @ layer.T)[of] * shares
        layer -= rate * mean.T @ error / np.float32(len(some))
        bias -= rate * error.mean(axis=0)
        by = np.argsort(buckets, kind="stable")
        starts = np.flatnonzero(np.diff(buckets[by], prepend=-1))
        vectors[buckets[by][starts]] -= rate * np.add.reduceat(back[by], starts)
    lean = layer[:, 1] - layer[:, 0]
    return Model((vectors @ lean).astype(np.float64), float(bias[1] - bias[0]))


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", rows: int = TRAINING_ROWS
) -> Model:
    """A model of ``labels.quality`` from at most ``rows`` labelled texts that are not held out, the first by a hash.

    The driver gets the different buckets of these texts, at most 2 ** BUCKET_BITS each. Documents with both labels are
    left out. With labels of one kind or none every text gets the same score, the smoothed share of label 1.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
    clear = known.agg(F.max("quality").cast("int").alias("label"), F.min("quality").cast("int").alias("least"))
    sample = clear.filter((F.col("label") == F.col("least")) & ~held_out()).select("doc_id", "label")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = F.broadcast(sample.orderBy(*order).limit(rows))
    training = pick(docs, doc_id=key, text=text).join(sample, "doc_id")

    def featured(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches.sliced(frames):
            found = list(Features(frame).rows())
            columns = [
                frame["doc_id"],
                frame["label"],
                pa.array([b for b, _ in found], pa.list_(pa.int32())),
                pa.array([s for _, s in found], pa.list_(pa.float32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "buckets", "shares"])

    kind = dict(training.dtypes)["doc_id"]
    found = training.mapInArrow(featured, f"doc_id {kind}, label int, buckets array<int>, shares array<float>")
    table = found.orderBy(*order, F.xxhash64("buckets", "shares")).select("label", "buckets", "shares").toArrow()
    given = table["label"].to_numpy().astype(np.int64)
    ones = int(given.sum())
    if not 0 < ones < len(given):
        return Model(np.zeros(DITTO + 1), float(np.log((ones + 0.5) / (len(given) - ones + 0.5))))
    lists = [table[c].combine_chunks() for c in ("buckets", "shares")]
    bounds = lists[0].offsets.to_numpy()
    flat = [x.values.to_numpy() for x in lists]
    return train(given, [tuple(x[a:b] for x in flat) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, score, predicted) for every row: how likely its text is a good one, from the whole text alone.

    A null or empty text has no features and gets the softmax of the bias. Repeated rows give repeated rows.
    """

    def scored(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches.sliced(frames):
            total, count = Features(frame).sums(model.values)
            logit = np.clip(total / np.maximum(count, 1) + model.bias, -30, 30)
            yield pa.RecordBatch.from_arrays([frame["doc_id"], pa.array(1 / (1 + np.exp(-logit)))], names=["doc_id", "score"])

    rows = pick(docs, doc_id=key, text=text)
    found = rows.mapInArrow(scored, f"doc_id {dict(rows.dtypes)['doc_id']}, score double")
    return found.withColumn("predicted", (F.col("score") >= LEAST_SCORE).cast("int"))
