"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's
    ``spark.checkpoint.dir``. Where it is unset (tests) a folder of our own, but
    only if driver and executors are one process; else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is not set: executors would share no folder")
        found = f"/tmp/tesselorn-{spark.sparkContext.applicationId}"
        spark.sparkContext.setCheckpointDir(found)
        _made.append((spark, found))
    return found.rstrip("/")


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.delete(at, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    _made.append((spark, path))


@atexit.register
def _remove_all() -> None:
    for spark, path in _made:
        try:
            remove(spark, path)
        except Exception:  # noqa: BLE001 - the session may have ended already
            return


def state(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of a table's files, on any store that Spark reads."""
    at, fs = _at(spark, path)
    files = sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(at))
    return f"{at.toUri()} {files}"


def _place(spark: SparkSession, name: str, key: str) -> str:
    return f"{shared_dir(spark)}/tesselorn-{name}-{hashlib.sha256(key.encode()).hexdigest()[:24]}"


def found(spark: SparkSession, name: str, key: str) -> DataFrame | None:
    """The table that ``kept`` made of this name and key, if it has."""
    path = _place(spark, name, key)
    at, fs = _at(spark, path)
    return spark.read.parquet(path) if fs.exists(at) else None


def kept(spark: SparkSession, name: str, key: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table ``make`` gives, stored under ``name`` and a hash of ``key``: made
    once for each key, then read. It is written aside and renamed when whole, so
    a run that was killed leaves no half; of two makers the first one's stays."""
    path = _place(spark, name, key)
    at, fs = _at(spark, path)
    if not fs.exists(at):
        aside = f"{path}-{uuid.uuid4().hex}"
        make().write.parquet(aside)
        if not fs.rename(_at(spark, aside)[0], at) or fs.exists(_at(spark, f"{path}/{aside.rsplit('/', 1)[1]}")[0]):
            remove(spark, aside)
            remove(spark, f"{path}/{aside.rsplit('/', 1)[1]}")
    return spark.read.parquet(path)
