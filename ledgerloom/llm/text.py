"""Word and hash helpers over text columns, all built-in expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _any_of(codes) -> str:
    """A character class that lists its members; Java looks these up in a table, ranges it tests one by one."""
    return "[" + "".join(f"\\x{c:02X}" for c in codes) + "]"


BLANKS = _any_of([0x20, *range(0x09, 0x0E)])
# Runs of ASCII characters that are neither digits nor lower-case letters: what stands between plain words
NOT_PLAIN = _any_of([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]) + "+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often ``body`` uses it and from within which lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The maximal runs of characters that are not blank; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{BLANKS}+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case; all other characters stay."""
    return F.translate(text, UPPER, LOWER)


def positions(first: int, last: Column) -> Column:
    """``first`` to ``last``; empty where ``last`` is smaller."""
    return F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>"))


def window_hashes(items: Column, width: int) -> Column:
    """A 64-bit hash of every ``width`` neighbouring elements, in order; ``items`` should be bound by ``let``."""
    starts = positions(1, F.size(items) - width + 1)
    return F.transform(starts, lambda i: F.xxhash64(F.slice(items, i, width)))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator works on, under names of its own, so that no other column can clash with them."""
    return df.select(*[F.col(f"`{name}`").alias(alias) for alias, name in columns.items()])
