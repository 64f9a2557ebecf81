"""The prefix trie of conversations: every distinct beginning is a node, with totals over all that start with it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import pick
from ledgerloom.sources.scratch import stored

# Turns that a task holds at a time, about; a longer conversation is held whole
SHARD_TURNS = 200_000
# Columns of a padded matrix of turn ids; longer conversations go on in the next matrix, the others do not
WIDTH = 32
# Turns by which conversations are dealt in ranges. Different ones that share all of these stay together
RANGE_TURNS = 1024
HEAD_TURNS = 9
HEAD_EVERY = 5

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_ROOT = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))

_PARTIAL = (
    "shard int, depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, parent_conv_id long, n_convs long,"
    " n_children long, n_leaves long, saved_tokens long, open boolean, open_parent boolean, e1 long, e2 long"
)
_TYPES = {"shard": pa.int32(), "open": pa.bool_(), "open_parent": pa.bool_()}
_FIELDS = [f.split()[0] for f in _PARTIAL.split(",")]


def turn_ids(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): for each conversation the 128-bit ids and text bytes of its turns, in order.

    Turns of one number are ordered by role and text. Null roles and texts are empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    ids = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id",
        F.col("turn").isNotNull().alias("numbered"),
        F.col("turn").alias("turn"),
        F.xxhash64(role, text).alias("hi"),
        F.xxhash64(F.lit("lo"), text, role).alias("lo"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.xxhash64(role).alias("by_role"),
    )
    base = F.col("conv_id") - F.col("conv_id") % HEAD_EVERY
    dealt = ids.withColumn("base", base).repartition("base")
    cell = F.struct("numbered", "turn", "by_role", "hi", "lo", "bytes")
    return dealt.groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(cell)).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, hi, lo, bytes): each conversation with the head of the one that begins its group of five.

    Of conversation c the first h turns, h = crc32(c) % 9, are those of c - c % 5: fewer where that has fewer, none
    where it is absent.
    """
    own = turn_ids(turns)
    heads = own.filter(F.col("conv_id") == F.col("base")).select("base", F.slice("turns", 1, HEAD_TURNS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_TURNS).cast("int")
    none = F.array().cast(own.schema["turns"].dataType)
    head = F.slice(F.coalesce("head", none), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    joined = own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("turns"))
    return joined.select("conv_id", *[F.col(f"turns.{c}").alias(c) for c in ("hi", "lo", "bytes")])


def _common(a: Column, b: Column) -> Column:
    """How many first elements two arrays share; -1 where one of them is null."""
    shorter = F.least(F.size(a), F.size(b))
    differing = F.array_position(F.zip_with(F.slice(a, F.lit(1), shorter), F.slice(b, F.lit(1), shorter), lambda x, y: x != y), True)
    return F.when(a.isNull() | b.isNull(), -1).otherwise(F.when(differing > 0, differing - 1).otherwise(shorter))


def _borders(shards: DataFrame) -> dict[int, tuple[int, int]]:
    """How many turns each shard's first conversation shares with the one before, and its last with the next.

    The driver gets three numbers a shard.
    """
    whole = F.zip_with("hi", "lo", lambda h, l: F.struct(h.alias("h"), l.alias("l")))
    ends = shards.groupBy("shard").agg(F.min(whole).alias("first"), F.max(whole).alias("last"))
    order = Window.orderBy("shard")
    before = _common(F.lag("last").over(order), F.col("first"))
    after = _common(F.col("last"), F.lead("first").over(order))
    found = ends.select("shard", before.alias("before"), after.alias("after"))
    return {r["shard"]: (r["before"], r["after"]) for r in found.collect()}


def sorted_rows(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of sequences, and how many first elements each shares with the one before it (the first: 0).

    ``ids`` holds all elements, numbered from 1; sequence i begins at ``begin[i]`` and has ``size[i]`` elements. Padded
    matrices of WIDTH columns are sorted by lexsort, one after the other: of each the rows that go on and are not told
    apart yet. Changes between neighbouring rows, accumulated by OR from column to column, mark where they part.
    """
    n = len(begin)
    order, shared = np.arange(n), np.zeros(n, np.int64)
    # places of the sorted rows that are still equal to a neighbour, and the group of equal ones that they are in
    place, group = np.arange(n), np.zeros(n, np.int64)
    at = 0
    while len(place):
        rows = order[place]
        cell = np.minimum(begin[rows][:, None] + at + np.arange(WIDTH), max(len(ids) - 1, 0))
        inside = at + np.arange(WIDTH) < size[rows][:, None]
        matrix = np.where(inside, ids[cell], 0) if len(ids) else np.zeros((len(rows), WIDTH), np.int64)
        by = np.lexsort((*matrix.T[::-1], group))
        order[place], matrix, inside = rows[by], matrix[by], inside[by]
        changed = np.zeros(matrix.shape, bool)
        changed[1:] = matrix[1:] != matrix[:-1]
        changed[0] = True
        changed[1:][group[1:] != group[:-1]] = True
        parted = np.logical_or.accumulate(changed, axis=1)
        same_group = np.zeros(len(place), bool)
        same_group[1:] = group[1:] == group[:-1]
        shared[place[same_group]] += (~parted & inside)[same_group].sum(axis=1)
        # rows go on where they are as long as the matrix and equal to the row before or after
        equal = same_group & ~parted[:, -1] & inside[:, -1]
        going = equal.copy()
        going[:-1] |= equal[1:]
        place, group = place[going], np.cumsum(~equal)[going]
        at += WIDTH
    return order, shared


def _chained(key: np.ndarray, more: np.ndarray, lane: int) -> np.ndarray:
    mixed = (key ^ (key >> np.uint64(30))) * _MIX[lane]
    return (mixed ^ (mixed >> np.uint64(27))) * _MIX[1 - lane] + more


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _nodes_of(table: pa.Table, borders: dict[int, tuple[int, int]]) -> pa.Table:
    """The nodes of one shard, with the totals of its own conversations."""
    shard = table["shard"][0].as_py()
    before, after = borders[shard]
    size = table["size"].to_numpy()
    begin = np.cumsum(size) - size
    hi, lo, n_bytes = (_flat(table[c]) for c in ("hi", "lo", "bytes"))
    # Ids become small numbers from 1 on, in the order of the ids
    if len(hi):
        order = np.lexsort((lo, hi))
        new = np.ones(len(hi), bool)
        new[1:] = (hi[order][1:] != hi[order][:-1]) | (lo[order][1:] != lo[order][:-1])
        ids = np.empty(len(hi), np.int64)
        ids[order] = np.cumsum(new)
    else:
        ids = np.empty(0, np.int64)
    order, shared = sorted_rows(ids, begin, size)
    begin, size = begin[order], size[order]
    n, least, e1, e2 = (table[c].to_numpy()[order] for c in ("n", "least", "s1", "s2"))
    shared[0] = before
    following = np.append(shared[1:], after)
    # The last conversation of a leaf is one that the next one does not go on
    leaf = (following < size).astype(np.int64)
    # Bytes in each turn of each conversation that are there more often than once for the node
    again = np.repeat(n, size)
    row_of = np.repeat(np.arange(len(size)), size)
    cell = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(len(row_of))
    at = np.arange(len(row_of)) - np.repeat(np.cumsum(size) - size, size) + 1
    first_seen = at > np.repeat(shared, size)
    saved = n_bytes[cell] * (again - first_seen)
    # what a conversation saves from depth d on: all but what it saves before
    upto = np.concatenate([[0], np.cumsum(saved)])
    base = np.cumsum(size) - size
    ends_at = upto[base + size]

    parts: dict[str, list[np.ndarray]] = {name: [] for name in _FIELDS}
    alive = np.arange(len(size))
    keys = [np.full(len(size), r) for r in _ROOT]
    parent = [np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)]
    parent_conv = np.zeros(len(size), np.int64)
    parent_open = np.zeros(len(size), bool)
    depth = 0
    while len(alive):
        if depth:
            of = cell[base[alive] + depth - 1]
            parent = [k[alive] for k in keys]
            for lane, part in enumerate((hi, lo)):
                keys[lane][alive] = _chained(keys[lane][alive], part[of].view(np.uint64), lane)
        marks = shared[alive] < depth
        marks[0] = True
        starts = np.flatnonzero(marks)
        mine = alive[starts]
        longer = size[alive] > depth
        conv = np.minimum.reduceat(least[alive], starts)
        span = np.diff(np.append(starts, len(alive)))
        ended = size[mine] == depth
        # A node of which a neighbouring shard has conversations, too: on the path shared with the one before or after
        is_open = np.zeros(len(starts), bool)
        is_open[0] |= shared[0] >= depth and alive[0] == 0
        is_open[-1] |= after >= depth and alive[-1] == len(size) - 1
        from_here = ends_at[alive] - upto[base[alive] + max(depth - 1, 0)]
        found = {
            "shard": np.full(len(starts), shard),
            "depth": np.full(len(starts), depth),
            "k1": keys[0][mine].view(np.int64),
            "k2": keys[1][mine].view(np.int64),
            "p1": parent[0][starts].view(np.int64),
            "p2": parent[1][starts].view(np.int64),
            "conv_id": conv,
            "parent_conv_id": parent_conv[mine],
            "n_convs": np.add.reduceat(n[alive], starts),
            "n_children": np.add.reduceat((longer & (shared[alive] <= depth)).astype(np.int64), starts),
            "n_leaves": np.add.reduceat(leaf[alive], starts),
            "saved_tokens": np.add.reduceat(from_here, starts),
            "open": is_open,
            "open_parent": parent_open[mine],
            "e1": np.where(ended, e1[mine], 0),
            "e2": np.where(ended, e2[mine], 0),
        }
        for name, values in found.items():
            parts[name].append(values)
        parts.setdefault("ended", []).append(ended)
        parent_conv[alive] = np.repeat(conv, span)
        parent_open[alive] = np.repeat(is_open, span)
        alive = alive[longer]
        depth += 1
    ended = np.concatenate(parts.pop("ended"))
    columns = {name: np.concatenate(values) for name, values in parts.items()}
    arrays = [
        pa.array(columns[name], _TYPES.get(name, pa.int64()), mask=~ended if name in ("e1", "e2") else None) for name in _FIELDS
    ]
    return pa.Table.from_arrays(arrays, names=_FIELDS)


def _listed(ends: DataFrame) -> DataFrame:
    """(s1, s2, sha256): the digest of the ids of equal conversations, ascending, comma-joined.

    Ids are sorted in ranges, so that many equal conversations are listed by many tasks; the texts of a list then pass
    through one digest piece by piece.
    """
    order = ("s1", "s2", "conv_id")
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ends.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order)

    def pieces(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            s1, s2, ids = (frame[c].to_numpy() for c in order)
            new = np.ones(len(ids), bool)
            new[1:] = (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])
            new[:1] = True
            starts = np.flatnonzero(new)
            texts = ids.astype(str).tolist()
            joined = [",".join(texts[a:b]) for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(s1[starts]), pa.array(s2[starts]), pa.array(ids[starts]), pa.array(joined, pa.string())],
                names=["s1", "s2", "first", "piece"],
            )

    listed = ranged.mapInArrow(pieces, "s1 long, s2 long, first long, piece string")
    gathered = listed.repartition("s1", "s2").sortWithinPartitions("s1", "s2", "first")

    def digests(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for frame in frames:
            done = []
            for s1, s2, piece in zip(*(frame[c].to_pylist() for c in ("s1", "s2", "piece")), strict=True):
                if (s1, s2) == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (s1, s2), hashlib.sha256()
                digest.update(piece.encode())
            yield _digested(done)
        if key is not None:
            yield _digested([(*key, digest.hexdigest())])

    return gathered.mapInArrow(digests, "s1 long, s2 long, sha256 string")


def _digested(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string())
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
    return pa.RecordBatch.from_arrays(columns, names=["s1", "s2", "sha256"])


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node of the trie of (conv_id, hi, lo, bytes); see ``conversation_trie``.

    Equal conversations become one row with their number before anything else. The others are sorted in ranges of
    whole beginnings, so a shard's nodes are its own but for those on the path that its first conversation shares with
    the shard before, or its last one with the shard after. All totals are sums over conversations once it is known
    what each shares with the one before it, so such open nodes are added up over the shards.
    """
    named = sequences.select(
        "conv_id", "hi", "lo", "bytes", F.xxhash64("hi", F.size("hi")).alias("s1"), F.xxhash64("lo", F.lit("s")).alias("s2")
    )
    marked = stored(named, "conversations")
    same = marked.groupBy("s1", "s2").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("least"),
        *[F.first(c).alias(c) for c in ("hi", "lo", "bytes")],
    )
    n_turns = marked.agg(F.sum(F.size("hi"))).first()[0] or 0
    least_shards = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_shards = max(least_shards, -(-n_turns // shard_turns))
    key = F.zip_with(F.slice("hi", 1, RANGE_TURNS), F.slice("lo", 1, RANGE_TURNS), lambda h, l: F.struct(h.alias("h"), l.alias("l")))
    ranged = same.withColumn("size", F.size("hi").cast("long")).repartitionByRange(n_shards, key)
    shards = stored(ranged.withColumn("shard", F.spark_partition_id()), "shards")
    borders = _borders(shards)
    parts = stored(shards.groupBy("shard").applyInArrow(lambda table: _nodes_of(table, borders), _PARTIAL), "trie-parts")

    totals = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    node = ("k1", "k2", "depth")
    shared = parts.filter("open")
    whole = shared.groupBy(*node).agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in totals],
        *[F.max(c).alias(c) for c in ("p1", "p2", "e1", "e2")],
        F.min("shard").alias("shard"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.max("open_parent").alias("open_parent"),
    )
    whole = stored(whole, "open-nodes")
    # The least id of an open node goes back to the shards that have it, so its children meet it shard by shard
    seen = shared.select("shard", *node).join(whole.select(*node, F.col("conv_id").alias("of_parent")), list(node))
    seen = seen.select("shard", F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), "of_parent")
    nodes = parts.filter("NOT open").drop("open").unionByName(whole)
    found = nodes.filter("open_parent").join(seen, ["shard", "p1", "p2", "depth"]).withColumn("parent_conv_id", F.col("of_parent"))
    nodes = found.drop("of_parent").unionByName(nodes.filter("NOT open_parent"))
    named = nodes.join(
        _listed(marked).select(F.col("s1").alias("e1"), F.col("s2").alias("e2"), "sha256"), ["e1", "e2"], "left"
    )
    ends = F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    parent = F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id")
    return named.select("conv_id", "depth", parent, *totals, ends)


def conversation_trie(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for each distinct beginning of the rebuilt conversations, see ``rebuilt``.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): the least member and
    its number of turns name a node; ``saved_tokens`` are the bytes of repeated turns in its subtree.

    Texts leave the first scan as 128-bit ids and sizes. Rows without a conv_id belong to no conversation. Null roles
    and texts are empty, turns without a number come first, rows of one number are ordered by the ids of their roles and
    texts, so repeated rows stay and reruns agree. A conversation is held as one row of 24 bytes a turn. An empty table
    has no node.
    """
    return prefix_trie(rebuilt(pick(turns, conv_id=conv_id, turn=turn, role=role, text=text)))
