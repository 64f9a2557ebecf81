"""Readers and writers for CSV and Parquet tables and for snapshot-partitioned stores."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom import fixed_values as fv
from ledgerloom.functions.casting import quoted
from ledgerloom.sources import folders
from ledgerloom.sources.scratch import shuffles_removed

CORRUPT = "_corrupt_record"
# Of the tables that are kept; text columns take about half of what they take with Spark's default
COMPRESSION = "zstd"
TOO_MANY, TOO_FEW, UNREADABLE = "too many fields", "too few fields", "unreadable"


def read_csv_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV with a header row, every column text. Only the header line is looked at to name the columns.

    A file whose header differs from the first one's is an error, not a table with swapped columns.
    """
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def read_csv_checked(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """As ``read_csv_text``, with one more column: the whole line where it does not fit the header, else null.

    All fields are read whatever is selected later, as what is not read cannot be missed.
    """
    header = read_csv_text(spark, path).schema
    checked = StructType([*header.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(checked).option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    return reader.option("header", True).option("enforceSchema", False).csv(path)


def fitting(checked: DataFrame) -> DataFrame:
    """The rows that fit the header, without the column for those that do not."""
    return checked.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def misfits(checked: DataFrame) -> DataFrame:
    """(record, first_field, fields, expected, reason) of the lines that do not fit the header."""
    expected = len(checked.columns) - 1
    # what is in quotes holds no separators
    bare = F.regexp_replace(CORRUPT, r'"(?:[^"\\]|\\.|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    reason = F.when(fields > expected, TOO_MANY).when(fields < expected, TOO_FEW).otherwise(UNREADABLE)
    return checked.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("record"),
        F.col(quoted(checked.columns[0])).alias("first_field"),
        fields.cast("int").alias("fields"),
        F.lit(expected).alias("expected"),
        reason.alias("reason"),
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def overwrite_parquet(df: DataFrame, path: str) -> None:
    """Replace a whole table. The rows stay in the partitions they are in, so nothing is shuffled for the write."""
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)


def bucketed_name(path: str) -> str:
    """The name in the session catalog of the bucketed table at a path."""
    return f"ledgerloom_{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:24]}"


def overwrite_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Replace a whole table by one that is dealt into buckets by its keys and sorted by them in each.

    A later join or window by the same keys then shuffles nothing of it, if Spark has no more shuffle partitions than
    there are buckets; it sorts what is in order already. It is plain Parquet for readers that know of no buckets.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path).option("compression", COMPRESSION)
    with shuffles_removed(df.sparkSession):
        writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(bucketed_name(path))


def read_bucketed(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A table that ``overwrite_bucketed`` wrote, also in a session other than the one that wrote it."""
    name = bucketed_name(path)
    if not spark.catalog.tableExists(name):
        listed = ", ".join(map(quoted, keys))
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({listed}) SORTED BY ({listed})"
            f" INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def at_snapshot(df: DataFrame, *dates: str | date) -> DataFrame:
    """Rows of the given snapshots; prunes partitions of a snapshot store."""
    return df.filter(F.col(fv.SNAPSHOT).isin([F.lit(str(d)).cast("date") for d in dates]))


def overwrite_snapshots(
    df: DataFrame, path: str, dates: Sequence[str | date] | None = None, gather: bool = False
) -> None:
    """Replace only the snapshots that are written, one folder per ``snapshot_date``.

    ``gather`` brings the rows of a snapshot together first where the input is not laid out by snapshot yet: it keeps
    each task from opening a file per snapshot, and the rebalance splits a snapshot that holds most of the rows.
    Snapshots named in ``dates`` that have no rows any more are removed; which ones were written is noted on the way.
    """
    written = Observation()
    laid_out = df.hint("rebalance", fv.SNAPSHOT) if gather else df
    noted = laid_out.observe(written, F.collect_set(fv.SNAPSHOT).alias("days"))
    writer = noted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
    with shuffles_removed(df.sparkSession):
        writer.partitionBy(fv.SNAPSHOT).parquet(path)
    for day in {str(d) for d in dates or ()} - {str(d) for d in written.get["days"]}:
        folders.delete(df.sparkSession, f"{path}/{fv.SNAPSHOT}={day}")


def read_snapshots(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """All snapshots of a store as one table. With a schema, a store without any rows can be read too."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


REJECT, PAD = "reject", "pad"


def ingest(
    spark: SparkSession, source: str, target: str, files: Mapping[str, str] | None = None, misfit: str = REJECT
) -> list[str]:
    """Turn every raw CSV into a bronze Parquet table; returns the table names.

    A line with more or fewer fields than the header goes to the table's rejects, see ``read_rejects``, and not to
    bronze; with ``pad`` it stays in bronze, cut or filled up with nulls. The lines of a file are read once; only where
    some did not fit, they are read again for these.
    """
    if misfit not in (REJECT, PAD):
        raise ValueError(f"misfit is {REJECT} or {PAD}, not {misfit}")
    mapping = files or fv.RAW_FILES
    for file, table in mapping.items():
        if misfit == PAD:
            overwrite_parquet(read_csv_text(spark, f"{source}/{file}"), f"{target}/{table}")
        else:
            _ingest_checked(spark, f"{source}/{file}", f"{target}/{table}", rejects_path(target, table))
    return list(mapping.values())


def _ingest_checked(spark: SparkSession, file: str, table: str, rejects: str) -> None:
    checked, seen = read_csv_checked(spark, file), Observation()
    counted = checked.observe(seen, F.count(CORRUPT).alias("misfits"))
    overwrite_parquet(fitting(counted), table)
    folders.delete(spark, rejects)
    if seen.get["misfits"]:
        overwrite_parquet(misfits(checked), rejects)


def rejects_path(target: str, table: str) -> str:
    return f"{target.rstrip('/')}_rejects/{table}"


REJECTS = "record string, first_field string, fields int, expected int, reason string"


def read_rejects(spark: SparkSession, target: str, table: str) -> DataFrame:
    """The lines that did not fit when ``table`` was last ingested below ``target``; no rows where all did."""
    path = rejects_path(target, table)
    if not folders.exists(spark, path):
        return spark.createDataFrame([], REJECTS)
    return spark.read.schema(REJECTS).parquet(path)
