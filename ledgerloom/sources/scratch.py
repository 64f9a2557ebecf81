"""Intermediate results in the shared folder that the cluster names."""

from __future__ import annotations

import atexit
import threading
import uuid
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources import folders


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir`` or, where that is unset, one below the warehouse folder.

    On a cluster a folder of one machine is never chosen: where the checkpoint folder is unset and the warehouse is on the
    driver's own disk, that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = f"{warehouse.rstrip('/')}/_ledgerloom"
        if not spark.sparkContext.master.startswith("local") and folders.scheme(spark, named) == "file":
            raise RuntimeError(f"{warehouse} is a folder of one machine: set spark.checkpoint.dir to one that all share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


_known: set[str] = set()


def _run_folder(spark: SparkSession) -> str:
    """The application's own folder, which is removed when the driver's Python ends."""
    folder = f"{shared_root(spark).rstrip('/')}/ledgerloom-{spark.sparkContext.applicationId}"
    if folder not in _known:
        _known.add(folder)
        path, conf = spark._jvm.org.apache.hadoop.fs.Path(folder), spark._jsc.hadoopConfiguration()
        atexit.register(_remove, path, conf)
    return folder


def _remove(path, conf) -> None:
    try:
        path.getFileSystem(conf).delete(path, True)
    except Exception:  # the JVM may be gone; what is left is in a folder named after the application
        pass


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared root, in the application's own folder."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"


_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_lock = threading.Lock()
_writing: list[str] = []


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Spark removes a write's shuffle files when it ends, not when the driver happens to collect its garbage.

    Writes may run side by side: the first one changes the setting and the last one puts it back.
    """
    with _lock:
        before = _writing[0] if _writing else spark.conf.get(_CLEANUP, "false")
        _writing.append(before)
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            _writing.pop()
            if not _writing:
                spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result once as Parquet in the scratch folder and read it back, which cuts its lineage.

    The files are in shared storage, so a lost executor costs no recomputation of what came before.
    """
    path = scratch_folder(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    result = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[result] = path
    return result


def discard(*frames: DataFrame) -> None:
    """Remove what ``stored`` has written for these frames, which nothing may read any more."""
    for df in frames:
        folders.delete(df.sparkSession, _paths.pop(df))


def clear_scratch(spark: SparkSession) -> None:
    """Remove all that this application has stored; frames read from it are of no use afterwards."""
    folders.delete(spark, _run_folder(spark))
