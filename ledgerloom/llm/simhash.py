"""SimHash near-duplicates: fingerprints, blocks that any close pair shares, and pivot distance tables in the blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.identity import digests, row_identity
from ledgerloom.llm.text import pick
from ledgerloom.sources.scratch import stored

SHINGLE = 3
SEED = 42
MOST_BITS = 3
# 64 bits in six blocks: of any pair with three differing bits at most, three blocks are equal, in one of 20 ways
BLOCKS = 6
PIVOTS = np.random.default_rng(7).integers(0, 2**64, size=8, dtype=np.uint64)
# Groups of up to so many fingerprints are compared by shifting the whole batch along itself
SHIFTED = 48
# Fingerprints of one block value that a task compares at once; larger groups are split into pairs of parts
PART = 20_000
SLAB = 1024


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text's word shingles, as an unsigned number. No words give 0."""
    items = (text or "").encode("utf-8", "replace").lower().split()
    if not items:
        return 0
    joined = b" ".join(items)
    width = min(width, len(items))
    ends = np.cumsum(np.fromiter(map(len, items), np.int64, len(items)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(items) - width + 1]
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 1 << 16):
        part = zip(starts[at : at + (1 << 16)].tolist(), ends[width - 1 :][at : at + (1 << 16)].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in part], dtype=np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed 64-bit number."""

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            found = np.fromiter((fingerprint(t.as_py(), width) for t in frame["text"]), np.uint64, frame.num_rows)
            yield pa.RecordBatch.from_arrays([frame["doc_id"], pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    narrow = pick(docs, doc_id=key, text=text)
    return narrow.mapInArrow(batches, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, fp long")


def _masks(blocks: int, most: int) -> list[int]:
    """One mask per way to choose the blocks that stay equal, as signed numbers."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - most)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _distance_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of every fingerprint to every pivot."""
    return np.stack([np.bitwise_count(fps ^ p).astype(np.int8) for p in PIVOTS], axis=1)


def _survivors(table: np.ndarray, x: np.ndarray, y: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose distances to no pivot differ by more than ``most``; only these can be that close to each other."""
    for c in range(table.shape[1]):
        near = np.abs(table[x, c] - table[y, c]) <= most
        x, y = x[near], y[near]
    return x, y


def _hook(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Merge the sets of all pairs (x, y) in place; ``root`` points to a set's least member."""
    while x.size:
        a, b = root[x], root[y]
        apart = a != b
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        low = np.minimum(a, b)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while not np.array_equal(root[root], root):
            root[:] = root[root]


def _dense_group(fps: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the sets of close fingerprints in one group: at most one per member, however many pairs.

    Rows are ordered by their distance to the first pivot, so each slab meets only rows of about its own distance.
    """
    table = _distance_table(fps)
    order = np.argsort(table[:, 0], kind="stable")
    fps, ids, table = fps[order], ids[order], table[order]
    root = np.arange(len(fps))
    for at in range(0, len(fps), SLAB):
        end = min(at + SLAB, len(fps))
        upto = np.searchsorted(table[:, 0], table[end - 1, 0] + most, side="right")
        for other in range(at, upto, SLAB):
            rest = slice(other, min(other + SLAB, upto))
            near = np.abs(table[at:end, None, 0] - table[None, rest, 0]) <= most
            for c in range(1, table.shape[1]):
                near &= np.abs(table[at:end, None, c] - table[None, rest, c]) <= most
            x, y = np.nonzero(near)
            x, y = x + at, y + other
            close = np.bitwise_count(fps[x] ^ fps[y]) <= most
            _hook(root, x[close], y[close])
    member = np.nonzero(root != np.arange(len(fps)))[0]
    return ids[member], ids[root[member]]


def _links(group: np.ndarray, fps: np.ndarray, ids: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links inside the groups of rows sorted by group number."""
    sizes = np.bincount(group)
    dense = np.nonzero(sizes > SHIFTED)[0]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    for g in dense:
        yield _dense_group(fps[starts[g] : starts[g + 1]], ids[starts[g] : starts[g + 1]], most)
    small = (sizes <= SHIFTED)[group] & (sizes > 1)[group]
    group, fps, ids = group[small], fps[small], ids[small]
    table = _distance_table(fps)
    for shift in range(1, SHIFTED):
        x = np.nonzero(group[:-shift] == group[shift:])[0]
        if not x.size:
            break
        x, y = _survivors(table, x, x + shift, most)
        close = np.bitwise_count(fps[x] ^ fps[y]) <= most
        yield ids[x[close]], ids[y[close]]


def close_links(distinct: DataFrame, most: int = MOST_BITS, blocks: int = BLOCKS, part: int = PART) -> DataFrame:
    """(a, b): links that connect all fingerprints at ``most`` or fewer differing bits, from distinct (fp, id).

    Any two such fingerprints agree in ``blocks - most`` whole blocks, so they meet under one of the block choices. In
    such a group a pivot distance table discards pairs by their largest coordinate difference and the rest are
    verified. A group of more than ``part`` rows is split: its rows are dealt into parts, and each pair of parts is a
    group of its own, so no task holds more than two parts.
    """
    spark = distinct.sparkSession
    choices = F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                        for i, m in enumerate(_masks(blocks, most))])
    keyed = distinct.select("fp", "id", F.inline(choices))
    large = stored(keyed.groupBy("c", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > part), "large")
    none = F.lit(0).cast("int")
    if large.isEmpty():
        dealt = keyed.select("c", "key", none.alias("i"), none.alias("j"), "fp", "id")
    else:
        parts = F.ceil(F.col("n") / part).cast("int")
        own = F.pmod(F.xxhash64("fp"), parts).cast("int")
        pairs = F.when(
            F.col("n").isNotNull(),
            F.transform(F.sequence(none, parts - 1), lambda o: F.struct(F.least(own, o), F.greatest(own, o))),
        ).otherwise(F.array(F.struct(none, none)))
        dealt = keyed.join(large, ["c", "key"], "left").select(
            "c", "key", "fp", "id", F.inline(pairs.cast("array<struct<i:int,j:int>>"))
        )

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def rows(arrays: list[np.ndarray], upto: int) -> Iterator[pa.RecordBatch]:
            *keys, fps, ids = [a[:upto] for a in arrays]
            new = np.zeros(upto, bool)
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            for a, b in _links(np.cumsum(new), fps.view(np.uint64), ids, most):
                if a.size:
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for frame in frames:
            if not frame.num_rows:
                continue
            arrays = [frame[c].to_numpy(zero_copy_only=False) for c in ("c", "key", "i", "j", "fp", "id")]
            arrays = arrays if held is None else [np.concatenate(x) for x in zip(held, arrays, strict=True)]
            same = np.ones(len(arrays[0]), bool)
            for k in arrays[:4]:
                same &= k == k[-1]
            last = int(np.nonzero(~same)[0][-1]) + 1 if not same.all() else 0
            if last:
                yield from rows(arrays, last)
            held = [a[last:].copy() for a in arrays]
        if held is not None:
            yield from rows(held, len(held[0]))

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_groups = dealt.repartition(n, "c", "key", "i", "j").sortWithinPartitions("c", "key", "i", "j")
    return sorted_groups.mapInArrow(batches, "a long, b long")


def _members(prints: DataFrame, most: int) -> DataFrame:
    """(fp, component_id): the least of the not-null ids of each fingerprint's group, from stored (doc_id, fp)."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "distinct-fingerprints")
    found = components(close_links(distinct.select("fp", F.col("fp").alias("id")), most))
    grouped = distinct.join(found.withColumnRenamed("node", "fp"), "fp")
    least = grouped.groupBy("component").agg(F.min("id").alias("least"))
    named = found.join(least, "component").select(F.col("node").alias("fp"), "least")
    joined = distinct.join(named, "fp", "left")
    return stored(joined.select("fp", F.coalesce("least", "id").alias("component_id")), "members")


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = SHINGLE, most: int = MOST_BITS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row: what group of near copies it is in.

    Texts link at ``most`` or fewer differing fingerprint bits. Equal fingerprints are one node, so a group of exact
    copies of any size costs one row. Null and empty texts have fingerprint zero and link like any other. Repeated rows
    give repeated rows; a null key is never a component's name unless all of the component's keys are null.
    """
    prints = stored(fingerprints(docs, text, key, width), "fingerprints")
    members = _members(prints, most)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(members, "fp", "left").select("doc_id", hexed.alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near copies the one with the least key.

    Repeated rows are copies too and one of them stays; different texts under one key, or none, are judged apart. All
    columns pass through. A row without a key stays only where its whole group has none, the first by its digest.
    """
    of, content = F.col(f"`{key}`"), F.col(f"`{text}`")
    rows = docs.select(row_identity(of, content).alias("doc_id"), content.alias("text"))
    members = _members(stored(fingerprints(rows), "fingerprints"), MOST_BITS)
    first = members.select(F.col("component_id.h1").alias("__h1"), F.col("component_id.h2").alias("__h2")).distinct()
    marked = docs.withColumns({f"__{n}": h for n, h in digests(of, content).items()})
    kept = marked.join(first, ["__h1", "__h2"], "left_semi")
    order = Window.partitionBy("__h1", "__h2").orderBy("__h1")
    numbered = kept.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") == 1)
    return numbered.select(*[F.col(f"`{c}`") for c in docs.columns])
