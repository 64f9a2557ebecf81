"""Snapshots whose columns differ, read as one table: columns by name, each as the narrowest type that holds all."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import fixed_values as fv
from ledgerloom.functions.casting import CASTS, quoted
from ledgerloom.sources.store import SnapshotStore

SAME, WIDENED, ADDED, MISSING = "same", "widened", "added", "missing"
REPORT = (
    f"{fv.SNAPSHOT} date, column string, status string, stored_type string, merged_type string, wanted_type string, not_castable long"
)
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds every value of both; text where there is no other."""
    if a == b:
        return a
    names = {a.simpleString(), b.simpleString()}
    if names <= set(_WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(t.simpleString()))
    decimals = [t for t in (a, b) if isinstance(t, T.DecimalType)]
    if decimals and all(isinstance(t, T.DecimalType) or t.simpleString() in _WHOLE for t in (a, b)):
        scale = max(t.scale for t in decimals)
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else _DIGITS[t.simpleString()] for t in (a, b))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    # a double holds every int, but not every bigint; a float not even every int
    if names <= {"tinyint", "smallint", "float"}:
        return T.FloatType()
    if names <= {"tinyint", "smallint", "int", "float", "double"}:
        return T.DoubleType()
    if names == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    return T.StringType()


def merged_schema(schemas: Mapping[str, T.StructType]) -> T.StructType:
    """All columns of all snapshots, in the order in which they first come up, oldest snapshot first."""
    found: dict[str, T.DataType] = {}
    for _, schema in sorted(schemas.items()):
        for field in schema.fields:
            found[field.name] = wider(found[field.name], field.dataType) if field.name in found else field.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in found.items()])


def _by_schema(store: SnapshotStore) -> dict[str, tuple[T.StructType, list[str]]]:
    """The different schemas of a store, from its manifest alone, each with its days."""
    found: dict[str, tuple[T.StructType, list[str]]] = {}
    for day, snapshot in sorted(store.snapshots().items()):
        if snapshot.rows:
            found.setdefault(snapshot.columns, (snapshot.schema, []))[1].append(day)
    return found


def _stored_as(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(fv.SNAPSHOT, T.DateType())])


def read_merged(store: SnapshotStore) -> DataFrame:
    """All snapshots of a store as one table with ``merged_schema``; what a snapshot does not have is null in it.

    One scan for each different schema, of the folders that have it. The manifest knows the schemas, so no file is
    opened to find them. Widening never loses a value.
    """
    groups = _by_schema(store)
    merged = merged_schema({days[0]: schema for schema, days in groups.values()})
    whole = _stored_as(merged)
    if not groups:
        return store.read(whole, [])

    def widened(schema: T.StructType, days: list[str]) -> DataFrame:
        has = set(schema.names)
        cells = [
            (F.col(quoted(f.name)) if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in merged.fields
        ]
        return store.read(_stored_as(schema), days).select(*cells, fv.SNAPSHOT)

    return reduce(DataFrame.unionAll, [widened(schema, days) for schema, days in groups.values()])


def _loses(name: str, wanted: str) -> Column:
    """Whether a value is there and the cast to the wanted type has none."""
    return F.col(quoted(name)).isNotNull() & CASTS[wanted](name).isNull()


def schema_report(store: SnapshotStore, wanted: Mapping[str, str] | None = None) -> DataFrame:
    """A row for every snapshot and column of the merged table or of ``wanted``.

    ``status`` is ``missing`` where the snapshot does not have a column that another one or ``wanted`` has, ``added``
    where the oldest snapshot did not have it, ``widened`` where its values were stored as a narrower type than they
    are read as, else ``same``. ``not_castable`` counts the values that are lost in the cast to the wanted type (0 for
    columns without one). The counts of all columns of a schema's snapshots come from one scan.
    """
    spark, wanted = store.spark, dict(wanted or {})
    groups = _by_schema(store)
    if not groups:
        return spark.createDataFrame([], REPORT)
    merged = merged_schema({days[0]: schema for schema, days in groups.values()})
    oldest = min(groups.values(), key=lambda g: g[1][0])[0]
    names = [*merged.names, *[c for c in wanted if c not in merged.names and c != fv.SNAPSHOT]]
    types = {f.name: f.dataType.simpleString() for f in merged.fields}

    def rows(schema: T.StructType, days: list[str]) -> DataFrame:
        text = [c for c in schema.names if c in wanted]
        table = store.read(_stored_as(schema), days)
        # the casts read text, so other types are looked at as text
        table = table.select(fv.SNAPSHOT, *[F.col(quoted(c)).cast("string").alias(c) for c in text])
        cells = []
        for name in names:
            stored = schema[name].dataType.simpleString() if name in schema.names else None
            if stored is None:
                status = MISSING
            elif name not in oldest.names:
                status = ADDED
            else:
                status = SAME if stored == types[name] else WIDENED
            lost = F.count_if(_loses(name, wanted[name])) if name in text else F.lit(0).cast("long")
            values = (name, status, stored, types.get(name), wanted.get(name))
            cells.append(F.struct(*[F.lit(v).cast("string") for v in values], lost))
        counted = table.groupBy(fv.SNAPSHOT).agg(F.array(*cells).alias("cells"))
        return counted.select(fv.SNAPSHOT, F.inline("cells"))

    columns = [f.split()[0] for f in REPORT.split(", ")]
    return reduce(DataFrame.unionAll, [rows(schema, days) for schema, days in groups.values()]).toDF(*columns)
