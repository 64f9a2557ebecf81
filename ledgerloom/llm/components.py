"""Connected components over a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.scratch import discard, stored

MOST_ROUNDS = 60


def _toward_least(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(u, v, m) for directed edges (u, v), with m the least of u and all its v; the minimum starts in each task.

    The second table is the stored (u, m), to be discarded when the first one has been read.
    """
    least = stored(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return edges.join(least, "u"), least


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the least node that can be reached from it.

    Each round hangs every node under the least node it sees, first its larger neighbours (large star), then itself and
    its smaller ones (small star), until nothing changes; the number of rounds grows with the logarithm of the longest
    path. Edges never become more, and all rounds are joins and aggregates; the driver sees a count and a checksum.
    Links of a node with itself, repeated ones and ones with a null are allowed.
    """
    a, b = F.col("a"), F.col("b")
    plain = links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stored(plain, "links")
    before = _signature(edges)
    for _ in range(MOST_ROUNDS):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        toward, least = _toward_least(both)
        large = stored(
            toward.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter(F.col("u") != F.col("v")).distinct(),
            "large-star",
        )
        discard(least)
        seen, least = _toward_least(large)
        moved = seen.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            seen.select("u", F.col("m").alias("v"))
        )
        last, edges = edges, stored(moved.filter(F.col("u") != F.col("v")).distinct(), "small-star")
        discard(last, large, least)
        after = _signature(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components have not settled in {MOST_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
