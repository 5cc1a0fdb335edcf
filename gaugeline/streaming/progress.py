"""Which files a stream has read, from its checkpoint, and which a stream or job has written."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.session import file_system, read_note
from gaugeline.sources.days import day_folders


def _last_commit(spark: SparkSession, checkpoint: str) -> int | None:
    fs, commits = file_system(spark, f"{checkpoint}/commits")
    if not fs.exists(commits):
        return None
    names = (status.getPath().getName() for status in fs.listStatus(commits))
    return max((int(name) for name in names if name.isdigit()), default=None)


def files_read(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(path) of the files in the batches that a stream over file sources has committed."""
    found = spark.createDataFrame([], "path string")
    last = _last_commit(spark, checkpoint)
    if last is None:
        return found
    # a version line, a line about the batch, then a line for each source
    lines = (read_note(spark, f"{checkpoint}/offsets/{last}") or "").splitlines()
    for number, line in enumerate(lines[2:]):
        if not line.startswith("{"):
            continue
        upto = int(json.loads(line)["logOffset"])
        entry = F.from_json("value", "path string, batchId long")
        log = spark.read.text(f"{checkpoint}/sources/{number}").filter(F.col("value").startswith("{"))
        paths = log.select(entry.alias("e")).filter(F.col("e.batchId") <= upto)
        path = F.regexp_replace("e.path", "^file:/+", "file:/")
        found = found.union(paths.select(path.alias("path")))
    return found.distinct()


_WRITTEN = "path string, size long, modified long"


def _sink_log(spark: SparkSession, path: str) -> list[str]:
    """The files that make up the log of a file sink: its last summary and the batches after it."""
    fs, log = file_system(spark, f"{path.rstrip('/')}/_spark_metadata")
    if not fs.exists(log):
        return []
    summary, batches = -1, {}
    for status in fs.listStatus(log):
        number, _, kind = status.getPath().getName().partition(".")
        if number.isdigit() and kind in ("", "compact"):
            if kind:
                summary = max(summary, int(number))
            batches.setdefault(int(number), {})[kind] = status.getPath().toString()
    return [
        found["compact"] if number == summary else found[""]
        for number, found in sorted(batches.items())
        if number == summary or (number > summary and "" in found)
    ]


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(value) of text files. Spark's text source takes files in a folder with an underscore for hidden."""
    text = spark._jsc.textFile(",".join(paths)).rdd()
    lines = spark._jsparkSession.createDataset(text, spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(lines.toDF(), spark)


def files_written(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, modified) of the files of a table: those that its sink has committed, or those in
    its folders if batch jobs write it."""
    log = _sink_log(spark, path)
    if log:
        lines = _lines(spark, log).filter(F.col("value").startswith("{"))
        entry = F.from_json("value", "path string, size long, modificationTime long, action string")
        files = lines.select(entry.alias("e")).filter("e.action = 'add'").select(
            "e.path", "e.size", F.col("e.modificationTime").alias("modified")
        )
    else:
        rows = []
        for folders in day_folders(spark, path).values():
            for folder in folders:
                fs, hadoop_path = file_system(spark, folder)
                found = fs.listFiles(hadoop_path, True)
                while found.hasNext():
                    status = found.next()
                    if not status.getPath().getName().startswith(("_", ".")):
                        rows.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
        files = spark.createDataFrame(rows, _WRITTEN)
    return files.withColumn("path", F.regexp_replace("path", "^file:/+", "file:/"))
