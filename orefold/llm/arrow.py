"""Row-wise Arrow operators: columns are passed through, new ones appended."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.shipping import ship
from orefold.llm.words import Texts, text_slices

TEXT = "__text"


@contextmanager
def small_batches(spark: SparkSession, rows: int):
    """Within, Spark hands tasks at most ``rows`` rows at a time, where rows carry whole texts."""
    ship(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append(docs: DataFrame, keep: list[Column], text: Column, added: T.StructType, work: Callable[[], Callable[[Texts, pa.RecordBatch], list[pa.Array]]]) -> DataFrame:
    """``keep`` and the columns ``added``, which ``work`` makes from each slice of whole texts.

    ``work`` is called once per task, so that it can build its tables there; the
    function it returns gets the texts of a slice and the slice's other columns.
    Rows are neither moved nor reordered, so equal ids and null ids do no harm.
    """
    ship(docs.sparkSession)
    source = docs.select(*keep, F.coalesce(text.cast("string"), F.lit("")).alias(TEXT))
    kept = T.StructType(source.schema.fields[:-1])
    schema = T.StructType(kept.fields + added.fields)
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = work()
        for batch in batches:
            for texts in text_slices(batch.column(batch.num_columns - 1)):
                rest = batch.slice(texts.first, len(texts))
                columns = rest.columns[:-1] + made(texts, rest)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, schema)
