"""Substring deduplication by content-defined chunks: a gear rolling hash cuts, digests of the chunks are compared."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.identity import numbered
from ledgerloom.sources.scratch import stored

GEAR = np.random.default_rng(20_11).integers(0, 2**32, size=256, dtype=np.uint32)
# Five bits of the rolling hash: a cut every 32 bytes beyond the least length. They depend on the last 17 bytes.
MASK = np.uint32(0x1F << 12)
LEAST, MOST = 16, 512
# Duplicate chunks are cut out where they make up so many bytes in a row
LEAST_RUN = 40


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash after every byte, ``h = (h << 1) + GEAR[byte]`` in 32 bits, for all bytes at once."""
    h = GEAR[data]
    for width in (1, 2, 4, 8, 16):
        shifted = np.zeros_like(h)
        shifted[width:] = h[:-width] << np.uint32(width)
        h = h + shifted
    return h


def cuts(data: bytes, least: int = LEAST, most: int = MOST) -> list[int]:
    """Where chunks end: at the first masked hash of zero ``least`` or more bytes on, after ``most`` bytes at the latest.

    A rest shorter than ``least`` stays with the last chunk. An insertion only moves the cuts around it.
    """
    size = len(data)
    if not size:
        return []
    hashes = gear_hashes(np.frombuffer(data, np.uint8))
    ends: list[int] = []
    start = 0
    for cut in (np.flatnonzero((hashes & MASK) == 0) + 1).tolist():
        if cut - start < least:
            continue
        while cut - start > most:
            start += most
            ends.append(start)
        if cut - start >= least:
            ends.append(cut)
            start = cut
    while size - start > most:
        start += most
        ends.append(start)
    if size - start >= least or not ends:
        ends.append(size)
    else:
        ends[-1] = size
    return ends


def chunk_table(docs: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(h1, h2, doc_id, start, size, again) for every chunk of every text; ``again``: as an earlier one of its text."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for at in range(0, frame.num_rows, 64):
                h1, h2, rows, starts, sizes, again = [], [], [], [], [], []
                part = frame.slice(at, 64)
                for i, text in enumerate(part["text"]):
                    data = (text.as_py() or "").encode("utf-8", "replace")
                    seen, start = set(), 0
                    for end in cuts(data, least, most):
                        digest = xxhash.xxh3_128_intdigest(data[start:end])
                        h1.append(digest >> 64)
                        h2.append(digest & 0xFFFFFFFFFFFFFFFF)
                        again.append(digest in seen)
                        seen.add(digest)
                        rows.append(i)
                        starts.append(start)
                        sizes.append(end - start)
                        start = end
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(h1, np.uint64).view(np.int64)),
                        pa.array(np.array(h2, np.uint64).view(np.int64)),
                        part["doc_id"].take(pa.array(rows, pa.int64())),
                        pa.array(starts, pa.int32()),
                        pa.array(sizes, pa.int32()),
                        pa.array(again, pa.bool_()),
                    ],
                    names=["h1", "h2", "doc_id", "start", "size", "again"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        batches, "h1 long, h2 long, doc_id long, start int, size int, again boolean"
    )


def merged(spans: Column, least_run: int) -> Column:
    """Sorted (start, size) spans that touch, joined to (start, end) runs of ``least_run`` or more."""
    shape = "array<struct<start:int,end:int>>"

    def closed(state: Column) -> Column:
        run = F.struct(state["start"].alias("start"), state["end"].alias("end"))
        return F.when(
            state["end"] - state["start"] >= least_run, F.array_append(state["out"], run)
        ).otherwise(state["out"])

    def step(state: Column, span: Column) -> Column:
        end = span["start"] + span["size"]
        touches = span["start"] <= state["end"]
        return F.struct(
            F.when(touches, state["start"]).otherwise(span["start"]).alias("start"),
            F.when(touches, F.greatest(state["end"], end)).otherwise(end).alias("end"),
            F.when(touches, state["out"]).otherwise(closed(state)).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.array().cast(shape).alias("out"))
    return F.aggregate(spans, zero, step, closed)


def repeated_chunks(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    least: int = LEAST,
    most: int = MOST,
    least_run: int = LEAST_RUN,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans) for every row: the bytes that repeat an earlier document's.

    Texts are cut as UTF-8 into chunks by their content, so equal passages give equal chunks wherever they stand. A
    chunk is a repeat where a document with a smaller key, or its own text further up, has one of the same 128-bit
    digest. ``spans`` are the runs (start, end) of ``least_run`` or more bytes of such chunks.

    Null and empty texts have no chunks. Keys are integers; a null one comes last; repeated rows count as one document,
    whose own copies stay; different texts under one key, or none, are documents of their own. Digests are counted from each task on, and only those that occur more than once
    are joined back to the chunks.
    """
    narrow = numbered(docs, text, key)
    cut = chunk_table(narrow.select(F.col("row").alias("doc_id"), "text"), least, most)
    order = F.col("doc_id")
    counted = cut.groupBy("h1", "h2").agg(F.min(order).alias("keep"), F.count(F.lit(1)).alias("n"))
    shared = stored(counted.filter(F.col("n") > 1).select("h1", "h2", "keep"), "shared-chunks")
    met = cut.join(shared, ["h1", "h2"]).filter((order > F.col("keep")) | F.col("again"))
    per_doc = met.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("found"))
    runs = per_doc.select(F.col("doc_id").alias("of"), merged(F.col("found"), least_run).alias("runs"))
    sized = narrow.select("doc_id", "row", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    joined = sized.join(runs, F.col("row") == F.col("of"), "left")
    spans = F.coalesce("runs", F.array().cast("array<struct<start:int,end:int>>"))
    removed = F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return joined.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size(spans).cast("long").alias("n_spans"), spans.alias("spans")
    )
