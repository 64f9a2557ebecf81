"""Exact substring deduplication over a sparse enhanced suffix array of all documents.

Every window of ``length`` bytes has one anchor: its ``GRAM``-byte string with the least hash, the first one of equals.
Equal windows have equal anchors at equal offsets, so a suffix array needs the suffixes at anchors only, and only of
anchors that several documents have. Suffixes are dealt out by anchor and sorted; common prefixes of neighbours form an
interval tree, which a stack scan walks; within an interval, members are told apart by what stands left of the anchor.
An interval of members with a common left extension is a repeat with all its occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.chunks import merged
from ledgerloom.llm.identity import numbered
from ledgerloom.sources.scratch import stored

LENGTH = 50
GRAM = 20
# Anchors with more occurrences than this are dealt out over several tasks
HOT = 20_000
# Anchors that a task gathers before it packs them
FLUSH = 1_000_000
# Most keys of touched documents that are broadcast to keep the other texts from being shuffled
BROADCAST_KEYS = 1_000_000
_MIX = np.random.default_rng(50).integers(0, 2**64, size=256, dtype=np.uint64)
_LOW = np.uint64(2**48 - 1)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A mixed 64-bit hash of the ``gram`` bytes that start at every place."""
    h = _MIX[data]
    spans, width = {1: h}, 1
    while 2 * width <= gram:
        h = h[:-width] * np.uint64(0x9E3779B97F4A7C15) + np.left_shift(h[width:], np.uint64(1)) if len(h) > width else h[:0]
        width *= 2
        spans[width] = h
    n, at, total = len(data) - gram + 1, 0, None
    for width in sorted(spans, reverse=True):
        if at + width <= gram:
            part = spans[width][at : at + n]
            total = part if total is None else total * np.uint64(0xBF58476D1CE4E5B9) + part
            at += width
    total = (total ^ (total >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return total ^ (total >> np.uint64(29))


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """For the window at every place, the hash and the place of its anchor; none for shorter texts."""
    if len(data) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least = gram_hashes(np.frombuffer(data, np.uint8), gram)
    place = np.arange(len(least))
    wide, width = length - gram + 1, 1
    while width < wide:
        step = min(width, wide - width)
        later = least[step:] < least[:-step]
        place = np.where(later, place[step:], place[:-step])
        least = np.where(later, least[step:], least[:-step])
        width += step
    return least, place


def _codes(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 48 more bits of a hash in one signed number: enough to tell anchors apart, which bytes verify later."""
    bucket = (hashes >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)
    return (bucket << np.uint64(48) | hashes & _LOW).view(np.int64)


def shared_anchors(docs: DataFrame, buckets: int, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(code, doc_id): the anchors that more than one document has, once per document.

    Tasks pack sorted anchors by bucket, 8 bytes each, so this is the only thing all anchors are shuffled for.
    """

    def pack(codes: list[np.ndarray], ids: list[int]) -> pa.RecordBatch:
        code = np.concatenate(codes).view(np.uint64)
        which = np.repeat(np.arange(len(ids), dtype=np.uint16), [len(c) for c in codes])
        order = np.argsort(code, kind="stable")
        code, which = code[order], which[order]
        bucket = (code >> np.uint64(48)).astype(np.int32)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        rest = (code & _LOW).view(np.uint8).reshape(-1, 8)[:, :6]
        of, rows = np.array(ids, np.int64), []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            used, local = np.unique(which[a:b], return_inverse=True)
            rows.append((int(bucket[a]), rest[a:b].tobytes(), local.astype(np.uint16).tobytes(), of[used].tobytes()))
        names = ["bucket", "rest", "local", "ids"]
        types = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names
        )

    def packed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ids, n = [], [], 0
        for frame in frames:
            for key, text in zip(frame["doc_id"].to_pylist(), frame["text"], strict=True):
                least, _ = anchors((text.as_py() or "").encode("utf-8", "replace"), length, gram)
                if not len(least):
                    continue
                codes.append(np.unique(_codes(least, buckets)))
                ids.append(key)
                n += len(codes[-1])
                if n >= FLUSH or len(ids) == 65_535:
                    yield pack(codes, ids)
                    codes, ids, n = [], [], 0
        if n:
            yield pack(codes, ids)

    def met(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ids = [], []
        for frame in frames:
            for bucket, rest, local, of in zip(*[frame[c].to_pylist() for c in ("bucket", "rest", "local", "ids")], strict=True):
                code = np.zeros((len(rest) // 6, 8), np.uint8)
                code[:, :6] = np.frombuffer(rest, np.uint8).reshape(-1, 6)
                codes.append(code.view(np.uint64).ravel() | np.uint64(bucket << 48))
                ids.append(np.frombuffer(of, np.int64)[np.frombuffer(local, np.uint16)])
        if not codes:
            return
        code, doc = np.concatenate(codes), np.concatenate(ids)
        del codes, ids
        order = np.argsort(code, kind="stable")
        code, doc = code[order], doc[order]
        starts = np.flatnonzero(np.diff(code, prepend=~code[:1]))
        several = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
        keep = np.repeat(several, np.diff(starts, append=len(code)))
        code, doc = code[keep].view(np.int64), doc[keep]
        for at in range(0, len(code), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(code[at : at + (1 << 16)]), pa.array(doc[at : at + (1 << 16)])], names=["code", "doc_id"]
            )

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blobs = docs.mapInArrow(packed, "bucket int, rest binary, local binary, ids binary")
    return blobs.repartition(n, "bucket").mapInArrow(met, "code long, doc_id long")


def anchored_suffixes(
    docs: DataFrame, shared: DataFrame, buckets: int, length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """(code, right, left, doc_id, at): at every shared anchor, the bytes of its windows from it on and, backwards, before.

    ``at`` is the anchor's place. Together, ``left`` and ``right`` cover the windows that have this anchor.
    """
    lists = shared.groupBy("doc_id").agg(F.collect_set("code").alias("codes"))

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for i in range(frame.num_rows):
                data = (frame["text"][i].as_py() or "").encode("utf-8", "replace")
                least, place = anchors(data, length, gram)
                first = np.flatnonzero(np.diff(place, prepend=-1))
                last = np.append(first[1:], len(place)) - 1
                code = _codes(least[first], buckets)
                wanted = np.isin(code, frame["codes"][i].values.to_numpy(zero_copy_only=False))
                first, last, code = first[wanted], last[wanted], code[wanted]
                at = place[first]
                triples = list(zip(first.tolist(), at.tolist(), (last + length).tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(code),
                        pa.array([data[p:e] for _, p, e in triples], pa.binary()),
                        pa.array([data[a:p][::-1] for a, p, _ in triples], pa.binary()),
                        pa.repeat(frame["doc_id"][i], len(code)),
                        pa.array(at.astype(np.int32)),
                    ],
                    names=["code", "right", "left", "doc_id", "at"],
                )

    return docs.join(lists, "doc_id").mapInArrow(batches, "code long, right binary, left binary, doc_id long, at int")


def common(a: bytes, b: bytes) -> int:
    """How many leading bytes two strings share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(x.argmax())


def intervals(lcp: Sequence[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(value, first, last) of the common-prefix intervals of sorted strings, by one scan with a stack.

    ``lcp[i]`` is what string i shares with string i - 1; ``lcp[0]`` does not count. Inner intervals come first, and
    only those of ``least`` or more.
    """
    stack: list[tuple[int, int]] = []
    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else -1
        start = i - 1
        while stack and stack[-1][0] > now:
            value, start = stack.pop()
            if value >= least:
                yield value, start, i - 1
        if not stack or stack[-1][0] < now:
            stack.append((now, start))


def repeats(
    right: Sequence[bytes], left: Sequence[bytes], length: int = LENGTH
) -> Iterator[tuple[int, int, list[int]]]:
    """(l, r, members) of the repeats of ``length`` or more bytes among different contexts of one anchor, sorted by right.

    All members share ``r`` bytes from the anchor on and ``l`` before it, and differ in both next bytes somewhere.
    """
    lcp = [0, *(common(a, b) for a, b in zip(right, right[1:]))]
    reach = max(map(len, left))
    for r, i, j in intervals(lcp, length - reach):
        members = sorted(range(i, j + 1), key=left.__getitem__)
        shared = [0, *(common(left[a], left[b]) for a, b in zip(members, members[1:]))]
        for l, a, b in intervals(shared, max(0, length - r)):  # noqa: E741
            yield l, r, members[a : b + 1]


def _spans(code: np.ndarray, right: pa.Array, left: pa.Array, doc: np.ndarray, at: np.ndarray, length: int):
    """(doc_id, start, end) of what repeats a smaller document's bytes, for rows sorted by code, right and left."""
    n = len(code)
    new_code = np.ones(n, bool)
    new_code[1:] = code[1:] != code[:-1]
    fresh = new_code.copy()
    if n > 1:
        differs = pc.or_(pc.not_equal(right[1:], right[:-1]), pc.not_equal(left[1:], left[:-1]))
        fresh[1:] |= differs.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(fresh)
    owner = np.minimum.reduceat(doc, starts)
    context = np.cumsum(fresh) - 1
    back = pc.binary_length(left).to_numpy().astype(np.int64)
    ahead = pc.binary_length(right).to_numpy().astype(np.int64)
    # The first document that has a context is covered as far as other contexts of smaller documents reach
    reach_back = np.zeros(len(starts), np.int64)
    reach_ahead = np.zeros(len(starts), np.int64)
    groups = np.flatnonzero(new_code[starts])
    for a, b in zip(groups.tolist(), np.append(groups[1:], len(starts)).tolist(), strict=True):
        if b - a < 2:
            continue
        rows = pa.array(starts[a:b])
        for l, r, members in repeats(right.take(rows).to_pylist(), left.take(rows).to_pylist(), length):  # noqa: E741
            which = np.array(members) + a
            later = which[owner[which] > owner[which].min()]
            reach_back[later] = np.maximum(reach_back[later], l)
            reach_ahead[later] = np.maximum(reach_ahead[later], r)
    own = doc == owner[context]
    back = np.where(own, reach_back[context], back)
    ahead = np.where(own, reach_ahead[context], ahead)
    found = (ahead > 0) & (at >= 0)
    return doc[found], (at - back)[found], (at + ahead)[found]


def repeated_spans(suffixes: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, size) of all that repeats a smaller document, from suffixes with a ``part`` column."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def rows(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            code, right, left, doc, at = (table[c].combine_chunks() for c in ("code", "right", "left", "doc_id", "at"))
            doc, start, end = _spans(
                code.to_numpy(), right, left, doc.to_numpy(), at.to_numpy().astype(np.int64), length
            )
            return pa.RecordBatch.from_arrays(
                [pa.array(doc), pa.array(start.astype(np.int32)), pa.array((end - start).astype(np.int32))],
                names=["doc_id", "start", "size"],
            )

        for frame in frames:
            if not frame.num_rows:
                continue
            table = pa.Table.from_batches([frame])
            table = table if held is None else pa.concat_tables([held, table])
            codes, parts = table["code"].to_numpy(), table["part"].to_numpy()
            other = np.flatnonzero((codes != codes[-1]) | (parts != parts[-1]))
            last = int(other[-1]) + 1 if len(other) else 0
            if last:
                # Parts of one code are judged apart
                edges = np.flatnonzero((np.diff(codes[:last]) == 0) & (np.diff(parts[:last]) != 0)) + 1
                for a, b in zip([0, *edges.tolist()], [*edges.tolist(), last], strict=True):
                    yield rows(table.slice(a, b - a))
            held = table.slice(last)
        if held is not None and held.num_rows:
            yield rows(held)

    n = int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = suffixes.repartition(n, "code", "part").sortWithinPartitions("code", "part", "right", "left")
    return dealt.mapInArrow(batches, "doc_id long, start int, size int")


def _dealt(docs: DataFrame, shared: DataFrame, buckets: int, length: int, gram: int, hot: int) -> DataFrame:
    """Suffixes with the part of their anchor's group that they are judged in: 0 but for hot anchors.

    The occurrences of a hot anchor are dealt into parts by document. Each part also gets the anchor's different
    contexts with the first document of each, gathered by an aggregate that starts in each task; nothing else decides
    on a span. These added rows have no place of their own. Only documents with a hot anchor are read again for them.
    """
    suffixes = anchored_suffixes(docs, shared, buckets, length, gram)
    large = stored(shared.groupBy("code").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot), "hot-anchors")
    none = F.lit(0).cast("int")
    if large.isEmpty():
        return suffixes.withColumn("part", none)
    parts = F.ceil(F.col("n") / hot).cast("int")
    own = F.coalesce(F.pmod(F.xxhash64("doc_id"), parts).cast("int"), none)
    at_hot = stored(shared.join(large.select("code"), "code"), "shared-hot-anchors")
    few = at_hot.select("doc_id").distinct()
    some = docs.join(F.broadcast(few), "doc_id", "left_semi") if few.count() <= BROADCAST_KEYS else docs
    contexts = anchored_suffixes(some, at_hot, buckets, length, gram).groupBy("code", "right", "left").agg(
        F.min("doc_id").alias("doc_id")
    )
    added = contexts.join(large, "code").select(
        "code", "right", "left", "doc_id", F.lit(-1).alias("at"), F.explode(F.sequence(none, parts - 1)).alias("part")
    )
    return suffixes.join(large, "code", "left").withColumn("part", own).drop("n").unionByName(added)


def _copies(given: DataFrame) -> DataFrame:
    """(row) of every row whose whole text, told by 128 bits, a row with a smaller number has too."""
    text = F.coalesce("text", F.lit(""))
    named = given.select("row", *[F.xxhash64(F.lit(h), text).alias(h) for h in ("h1", "h2")])
    several = named.groupBy("h1", "h2").agg(F.min("row").alias("least"), F.max("row").alias("most"))
    several = several.filter(F.col("least") < F.col("most")).drop("most")
    return named.join(several, ["h1", "h2"]).filter(F.col("row") > F.col("least")).select("row").distinct()


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    length: int = LENGTH,
    gram: int = GRAM,
    hot: int = HOT,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256) for every row.

    Removed is every byte covered by a ``length``-byte string that also starts in a document with a smaller key, judged
    on the input as UTF-8 bytes; ``spans`` are the maximal removed runs (start, end), ``kept_sha256`` digests the rest.

    Null texts are empty; keys are integers and a null one comes last. Repeated rows never repeat each other; different
    texts under one key, or none, are documents of their own, in the order of their digests. Without documents there are no rows.

    A text that a smaller row has as a whole is gone as a whole, if it has a window at all, and whatever it would take out
    of others its first copy takes out. So only first copies go into the suffix array.
    """
    spark = docs.sparkSession
    given = numbered(docs, text, key)
    copies = stored(_copies(given), "copies")
    known = F.broadcast(copies) if copies.count() <= BROADCAST_KEYS else copies
    narrow = given.join(known, "row", "left_anti").select(F.col("row").alias("doc_id"), "text")
    buckets = min(32_767, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shared = stored(shared_anchors(narrow, buckets, length, gram), "shared-anchors")
    suffixes = _dealt(narrow, shared, buckets, length, gram, hot)
    spans = repeated_spans(suffixes, length)
    per_doc = spans.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("found"))
    runs = stored(per_doc.select(F.col("doc_id").alias("of"), merged(F.col("found"), 1).alias("runs")), "repeated-runs")
    order = F.col("row")
    ids = runs.select("of")
    few = runs.count() <= BROADCAST_KEYS
    touched = given.join(F.broadcast(ids), order == F.col("of"), "left_semi") if few else given
    whole = given.select("doc_id", "row", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id",
        "row",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2("text", 256).alias("kept_sha256"),
    )
    untouched = whole.join(known, "row", "left_anti").join(F.broadcast(ids) if few else ids, order == F.col("of"), "left_anti")

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            sizes, digests = [], []
            for value, found in zip(frame["text"], frame["runs"].to_pylist(), strict=True):
                data = (value.as_py() or "").encode("utf-8", "replace")
                digest, at = hashlib.sha256(), 0
                for run in found:
                    digest.update(data[at : run["start"]])
                    at = run["end"]
                digest.update(data[at:])
                sizes.append(len(data))
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [frame["doc_id"], pa.array(sizes, pa.int64()), frame["runs"], pa.array(digests, pa.string())],
                names=["doc_id", "n_bytes", "spans", "kept_sha256"],
            )

    kind = given.schema["doc_id"].dataType.simpleString()
    shape = "array<struct<start:int,end:int>>"
    changed = touched.join(runs, order == F.col("of")).select("doc_id", "text", "runs").mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, spans {shape}, kept_sha256 string"
    )
    # copies are gone from their first byte to their last, but for those that are shorter than a window
    none, gone = F.array().cast(shape), F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end")))
    windowed = F.col("n_bytes") >= length
    again = whole.join(known, "row", "left_semi").withColumns(
        {
            "spans": F.when(windowed, gone.cast(shape)).otherwise(none),
            "kept_sha256": F.when(windowed, F.lit(hashlib.sha256().hexdigest())).otherwise(F.col("kept_sha256")),
        }
    )
    both = untouched.withColumn("spans", none).unionByName(again).drop("row").unionByName(changed)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return both.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "spans", "kept_sha256"
    )
