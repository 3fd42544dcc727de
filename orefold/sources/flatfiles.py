"""Delimited extract files with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.operators.skew import measure, same_key, set_aside
from orefold.schemas import BRONZE, struct
from orefold.session import limit, shuffles_dropped, stash

REJECT_COLUMN = "rejected_line"
# Condition in the error of a malformed line, as Spark's own readers name it.
MALFORMED = "MALFORMED_RECORD_IN_PARSING"


class TooManyRejects(RuntimeError):
    """More malformed lines than the load allows."""


def feed_path(root: str, table: str) -> str:
    """Path of one extract under ``root``: ``source_<system>/<entity>.csv``.

    ERP extracts carry upper-case names.
    """
    system, entity = table.split("_", 1)
    return f"{root.rstrip('/')}/source_{system}/{entity.upper() if system == 'erp' else entity}.csv"


def feed_paths(root: str) -> dict[str, str]:
    return {table: feed_path(root, table) for table in BRONZE}


def _reader(spark: SparkSession, schema: T.StructType, mode: str):
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ",")
        .option("mode", mode)
    )


def read_feed(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Strict read: header skipped, columns by position, empty field is NULL.

    A malformed line fails any read, also one of a single column or a mere count. Left
    to itself, Spark would convert only the columns that a query asks for; the error
    names the whole line as it was read, so every column belongs to the condition and
    none is pruned. Files are split by Spark, so one large file is read by many tasks.
    """
    schema = struct(columns).add(REJECT_COLUMN, T.StringType())
    parsed = _reader(spark, schema, "PERMISSIVE").option("columnNameOfCorruptRecord", REJECT_COLUMN).csv(path)
    line = F.concat(F.lit(f"[{MALFORMED}] "), F.col(REJECT_COLUMN), F.lit(" read as "), F.to_json(F.struct(*columns)))
    whole = F.when(F.col(REJECT_COLUMN).isNotNull(), F.raise_error(line).cast("boolean")).otherwise(True)
    return parsed.where(whole).drop(REJECT_COLUMN)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``line_number`` (from 1, the header's) and ``line`` of every line below ``path``.

    A file may be read in several pieces, each by some task. Lines keep their order
    within a piece; how many each piece has is counted first, a row per piece, and the
    sum of the pieces before it is added.
    """
    place = F.monotonically_increasing_id()
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__from"), place.alias("__id"), F.col("value").alias("line")
    )
    stored = stash(lines, "lines")
    pieces = stored.groupBy("file", "__from").agg(F.min("__id").alias("__first"), F.count("*").alias("__lines"))
    earlier = Window.partitionBy("file").orderBy("__from").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.select("file", "__from", (F.coalesce(F.sum("__lines").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    before = set_aside(before, ["file", "__from"])
    joined = stored.join(F.broadcast(before) if measure(before)[1] <= limit(spark, "broadcastBytes") else before, same_key(["file", "__from"]))
    return joined.select("file", (F.col("__id") + F.col("__shift")).alias("line_number"), "line")


def rejected_places(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """``file``, ``line_number`` and ``rejected_line`` of every malformed line, as the tolerant read finds them."""
    schema = struct(columns).add(REJECT_COLUMN, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT_COLUMN, "sep": ","}
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    lines = numbered_lines(spark, path).where((F.col("line_number") > 1) & (F.trim("line") != ""))
    parsed = lines.withColumn("__parsed", F.from_csv("line", fields, options))
    return parsed.where(F.col("__parsed")[REJECT_COLUMN].isNotNull()).select("file", "line_number", F.col("line").alias("rejected_line"))


def read_feed_tolerant(
    spark: SparkSession, path: str, columns: dict[str, str], max_rejects: int
) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejected lines; more than ``max_rejects`` lines is an error.

    The parsed file is stored once, so that counting the rejects and loading the
    good rows do not parse it twice.
    """
    schema = struct(columns).add(REJECT_COLUMN, T.StringType())
    parsed = stash(_reader(spark, schema, "PERMISSIVE").option("columnNameOfCorruptRecord", REJECT_COLUMN).csv(path), "feed")
    rejected = parsed.where(F.col(REJECT_COLUMN).isNotNull()).select(REJECT_COLUMN)
    found = rejected.count()
    if found > max_rejects:
        raise TooManyRejects(f"{found} malformed lines in {path}, {max_rejects} allowed")
    return parsed.where(F.col(REJECT_COLUMN).isNull()).drop(REJECT_COLUMN), rejected


def write_feed(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write an extract the reader understands: NULL and empty text are both empty fields.

    A compressed file is read by one task; there is one per task that wrote.
    """
    writer = (
        df.write.option("header", True)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSS")
        .option("compression", compression)
    )
    with shuffles_dropped(df.sparkSession):
        writer.csv(path)
