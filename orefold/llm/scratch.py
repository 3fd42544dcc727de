"""Intermediate tables in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orefold.session import hadoop_path, scratch_path


class Scratch:
    """Tables written to the folder of ``spark.checkpoint.dir``, so that a lost executor
    costs no recomputation, and removed once nothing reads them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(stored)] = path
        stored._orefold_scratch = self  # keeps the id from being used again
        return stored

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            files, path = hadoop_path(self.spark, self.paths.pop(id(table)))
            files.delete(path, True)


def width(spark: SparkSession, rows: int, per_task: int) -> int:
    """Partitions for ``rows``: at least the session's shuffle width, more where tasks would grow."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))
