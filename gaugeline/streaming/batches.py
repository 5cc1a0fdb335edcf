"""Tables that streams fill batch by batch through ``foreachBatch``.

A batch is a folder, ``batch=7``. A batch that Spark repeats after a failure replaces its folder, and only
batches up to the committed one are read, so a batch counts once and as a whole. The number of the committed batch is
written last. A batch that is repeated after that is passed over.

A table may instead hold its last batch only: a snapshot, which each batch replaces.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gaugeline.session import file_system, read_latest, write_latest

_COMMITTED = "_committed"


@dataclass(frozen=True)
class BatchTable:
    path: str
    schema: StructType
    partition_by: Sequence[str] = ()
    #: Whether only the last batch counts.
    snapshot: bool = False

    def committed(self, spark: SparkSession) -> int:
        return int(read_latest(spark, f"{self.path}/{_COMMITTED}") or -1)

    def write(
        self, rows: DataFrame, number: int, before_commit: Callable[[DataFrame], None] | None = None
    ) -> None:
        """Write a batch, hand it to ``before_commit`` and commit it, unless it was committed before."""
        spark = rows.sparkSession
        if number <= self.committed(spark):
            return
        folder = self._folder(number)
        rows.select(*self.schema.names).write.mode("overwrite").partitionBy(*self.partition_by).parquet(folder)
        if before_commit is not None:
            before_commit(self._read(spark, [number]))
        write_latest(spark, f"{self.path}/{_COMMITTED}", str(number))
        if self.snapshot:
            self._drop_before(spark, number - 1)  # the last one may still be read

    def read(self, spark: SparkSession) -> DataFrame:
        last = self.committed(spark)
        if last < 0:
            return spark.createDataFrame([], self.schema)
        return self._read(spark, [last] if self.snapshot else None, last)

    def _folder(self, number: int) -> str:
        return f"{self.path}/batch={number}"

    def _read(self, spark: SparkSession, numbers: list[int] | None, last: int | None = None) -> DataFrame:
        data = [f for f in self.schema.fields if f.name not in self.partition_by]
        stored = [*data, *(self.schema[name] for name in self.partition_by), StructField("batch", LongType())]
        reader = spark.read.schema(StructType(stored)).option("basePath", self.path)
        rows = reader.parquet(*([self.path] if numbers is None else map(self._folder, numbers)))
        if last is not None:
            rows = rows.filter(F.col("batch") <= last)  # on folders: no file of others is opened
        return rows.select(*self.schema.names)

    def _drop_before(self, spark: SparkSession, number: int) -> None:
        fs, root = file_system(spark, self.path)
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("batch=") and int(name.removeprefix("batch=")) < number:
                fs.delete(status.getPath(), True)
