"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: Files that a task writes at a time before it sorts its rows by folder instead.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
MOST_OPEN = "40"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def spark_session(app_name: str = "gaugeline") -> SparkSession:
    """A session in UTC, with streaming state on disk instead of in executor memory. Master,
    packages and credentials are left to spark-submit."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config(STATE_STORE, ROCKSDB)
        # points are many times the readings: they are not sorted by folder where a task has few folders
        .config(OPEN_FILES, MOST_OPEN)
        # times with least and greatest values in Parquet, so that reads of a range skip row groups
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        # lets AQE split hot folders in the file sinks of streams without state
        .config("spark.sql.adaptive.streaming.stateless.enabled", "true")
        .getOrCreate()
    )


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[SparkSession]:
    """Settings of the session for a while; names have dots for double underscores."""
    named = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in named}
    try:
        for name, value in named.items():
            spark.conf.set(name, value)
        yield spark
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def in_utc(spark: SparkSession):
    """UTC for a while: time zones are fixed when a plan is made, not when it runs."""
    return settings(spark, spark__sql__session__timeZone="UTC")


def with_rocksdb(spark: SparkSession):
    """Keep the state of streams started within off the executors' heap."""
    return settings(spark, **{STATE_STORE.replace(".", "__"): ROCKSDB})


def with_open_files(spark: SparkSession):
    """Let tasks keep a file open for each folder, up to MOST_OPEN, instead of sorting all of their rows by
    folder: for rows that come by folder. The sink of a stream looks at it while it runs."""
    return settings(spark, **{OPEN_FILES.replace(".", "__"): MOST_OPEN})


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names in spark.checkpoint.dir."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds a path, and the path as Hadoop sees it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def read_note(spark: SparkSession, path: str) -> str | None:
    """A small text file, which Spark's readers may take for hidden; None if there is none."""
    fs, file = file_system(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    fs, file = file_system(spark, path)
    stream = fs.create(file, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


#: Earlier numbers that stay, for readers that have just listed them.
_KEPT_NUMBERS = 3


def _numbers(fs, folder) -> list[int]:
    if not fs.exists(folder):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return sorted(int(name) for name in names if name.isdigit())


def read_latest(spark: SparkSession, folder: str) -> str | None:
    """The text that write_latest wrote last; None if there is none."""
    fs, path = file_system(spark, folder)
    numbers = _numbers(fs, path)
    return read_note(spark, f"{folder}/{numbers[-1]}") if numbers else None


def write_latest(spark: SparkSession, folder: str, text: str) -> None:
    """Write a text under the next number, whole or not at all: it gets its name once it is written."""
    fs, path = file_system(spark, folder)
    numbers = _numbers(fs, path)
    number = numbers[-1] + 1 if numbers else 0
    unnamed = f"{folder}/_{uuid.uuid4().hex}"
    write_note(spark, unnamed, text)
    _, source = file_system(spark, unnamed)
    _, target = file_system(spark, f"{folder}/{number}")
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"could not write {folder}/{number}; does another job write there?")
    for old in numbers[:-_KEPT_NUMBERS]:
        fs.delete(file_system(spark, f"{folder}/{old}")[1], False)
