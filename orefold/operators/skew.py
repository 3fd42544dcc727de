"""Finding the few keys that are too large for one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orefold.session import limit, stash


def aside(name: str) -> str:
    """Name of a key column on the other side of a join, so names never collide."""
    return f"__{name}"


def set_aside(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select([F.col(c).alias(aside(c)) if c in keys else F.col(c) for c in df.columns])


def same_key(keys: list[str]) -> Column:
    """Null-safe equality of ``keys`` with their set-aside names; still an equi-join."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(aside(k))) for k in keys])


def _sizes(df: DataFrame) -> tuple[Column, Column]:
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.simpleString() == "string"]
    width = reduce(lambda a, b: a + b, texts, F.lit(8 * (len(df.columns) - len(texts))))
    return F.count(F.lit(1)), F.coalesce(F.sum(width.cast("bigint")), F.lit(0))


def with_size(df: DataFrame, size: tuple[int, int] | None) -> DataFrame:
    """``df``, known to have at most this many rows and bytes."""
    if size is not None:
        df._orefold_size = size
    return df


def known_size(df: DataFrame) -> tuple[int, int] | None:
    return getattr(df, "_orefold_size", None)


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows, and bytes of all values: text by its length, anything else as eight; at most these if known already."""
    if known_size(df) is None:
        with_size(df, tuple(df.agg(*_sizes(df)).collect()[0]))
    return known_size(df)


def measured(df: DataFrame) -> DataFrame:
    """``df`` with its size, found by one job unless known."""
    measure(df)
    return df


def narrowed(df: DataFrame, *columns: str) -> DataFrame:
    """Some columns; what is known of the whole bounds them."""
    return with_size(df.select(*columns), known_size(df))


def measured_stash(df: DataFrame, label: str) -> DataFrame:
    """``stash``, the size taken while writing."""
    seen = Observation()
    rows, size = _sizes(df)
    stored = stash(df.observe(seen, rows.alias("rows"), size.alias("size")), label)
    return with_size(stored, (seen.get["rows"], seen.get["size"]))


def short_list(per_key: DataFrame) -> DataFrame:
    """One row per hot key, for a broadcast if it measures small enough."""
    fits = measure(per_key)[1] <= limit(per_key.sparkSession, "hotListBytes")
    return F.broadcast(per_key) if fits else per_key


def hot_keys(df: DataFrame, keys: list[str], rows: int | None = None) -> DataFrame | None:
    """Keys with more rows than one task should take, or None; names set aside.

    A table with no more rows than that (``rows``, if counted already) has none.
    Otherwise the count per key reads only the key columns and combines before
    the shuffle, so it is itself immune to skew. There are at most rows / limit
    hot keys.
    """
    most = limit(df.sparkSession, "hotGroupRows")
    if (df.count() if rows is None else rows) <= most:
        return None
    counts = df.groupBy(*keys).agg(F.count("*").alias("__rows"))
    if counts.agg(F.max("__rows")).collect()[0][0] <= most:
        return None
    return short_list(stash(set_aside(counts.where(F.col("__rows") > most).select(*keys), keys), "hot-keys"))


def split_hot(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys, and rows of hot keys (None when there are none)."""
    hot = hot_keys(df, keys)
    if hot is None:
        return df, None
    return df.join(hot, same_key(keys), "left_anti"), df.join(hot, same_key(keys), "left_semi")
