"""Folders on whatever file system Spark reads from, and the removal of empty label folders."""

from __future__ import annotations

import hashlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_REPORT = "folder string, rows long, status string"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def scheme(spark: SparkSession, path: str) -> str:
    """Of the file system that a path is on, such as ``file`` or ``hdfs``."""
    return _file_system(spark, path)[0].getUri().getScheme()


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.delete(target, True)


def delete_empty(spark: SparkSession, path: str) -> bool:
    """Delete a folder that has nothing in it."""
    fs, target = _file_system(spark, path)
    return fs.exists(target) and not len(fs.listStatus(target)) and fs.delete(target, False)


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, without hidden and temporary ones."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target) or not fs.getFileStatus(target).isDirectory():
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isFile()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, such as a manifest."""
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file under a name that is not taken: whole beside it first, then renamed."""
    fs, target = _file_system(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(part, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(part, target):
        fs.delete(part, False)
        raise FileExistsError(f"{path} is there already: something else has written it meanwhile")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file over the one that is there."""
    fs, target = _file_system(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def listing_digest(spark: SparkSession, *paths: str) -> str:
    """A digest of the names, sizes and times of all files below some paths; nothing is read. A missing path counts."""
    found = []
    for path in paths:
        fs, target = _file_system(spark, path)
        listed = fs.listFiles(target, True) if fs.exists(target) else None
        while listed is not None and listed.hasNext():
            status = listed.next()
            found.append(f"{status.getPath()}|{status.getLen()}|{status.getModificationTime()}")
        found.append(f"{path}|{listed is not None}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the data folders in a folder; hidden and temporary ones are left out."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target) or not fs.getFileStatus(target).isDirectory():
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def _rows_by_folder(spark: SparkSession, root: str, names: list[str]) -> dict[str, int]:
    """Row counts of all folders by one job over the file footers; a folder without rows is not in the result."""
    base = spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath()
    below = F.substring_index(F.input_file_name(), f"{base}/", -1)
    folder = F.url_decode(F.substring_index(below, "/", 1))
    rows = spark.read.parquet(*[f"{root}/{n}" for n in names]).groupBy(folder.alias("folder")).count()
    return {r["folder"]: r["count"] for r in rows.collect()}


def _rows_in(spark: SparkSession, folder: str) -> int | None:
    """Rows of one folder, None where it cannot be read."""
    try:
        return spark.read.parquet(folder).count()
    except (PySparkException, Py4JJavaError):
        return None


def prune_empty_folders(spark: SparkSession, root: str) -> DataFrame:
    """Delete the folders of a store that hold no rows; (folder, rows, status) per folder.

    Status is ``kept``, ``deleted`` or, for a folder that cannot be read, ``skipped``. A missing root gives no rows.
    One job counts all folders; only the ones it found nothing in, or all of them if it failed, are looked at singly.
    """
    names = subfolders(spark, root)
    try:
        found = _rows_by_folder(spark, root, names) if names else {}
    except (PySparkException, Py4JJavaError):
        found = {}
    report = []
    for name in names:
        rows = found.get(name) or _rows_in(spark, f"{root}/{name}")
        status = "skipped" if rows is None else "kept" if rows else "deleted"
        if status == "deleted":
            delete(spark, f"{root}/{name}")
        report.append((name, rows, status))
    return spark.createDataFrame(report, _REPORT)
