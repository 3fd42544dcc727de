"""Lookups and existence tests.

A lookup side is broadcast only after a check of its size. Otherwise both sides
are shuffled and adaptive execution splits skewed partitions of the left side.
What it cannot split, a skewed right side of an outer join, is handled here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.operators.skew import aside, hot_keys, known_size, measure, set_aside
from orefold.session import limit, stash


def left_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left outer join on one key; the right key column is not returned.

    Keeps every left row and, as any join does, repeats it per match. A right side
    too large to broadcast is searched for keys that repeat more often than one
    task should take. Those are joined in parts, as many as the hottest key needs:
    each right row belongs to one of them by its place in a stored copy, wherever
    it was before, and each left row of that key visits all parts. Such keys have
    matches by definition, so an inner join is enough.
    """
    extra = [c for c in right.columns if c != right_key]
    clash = set(left.columns) & set(extra)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    columns = [*left.columns, *extra]
    match = F.col(left_key) == F.col(aside(right_key))
    # NULL keys match nothing, so what is measured is what is joined
    keyed = right.where(F.col(right_key).isNotNull())
    bound = known_size(right)
    right = set_aside(keyed, [right_key])
    small = bound is not None and bound[1] <= limit(left.sparkSession, "broadcastBytes")
    rows, size = bound if small else measure(keyed)
    if size <= limit(left.sparkSession, "broadcastBytes"):
        return left.join(F.broadcast(right), match, "left").select(*columns)
    hot = hot_keys(keyed, [right_key], rows)
    if hot is None:
        return left.join(right, match, "left").select(*columns)

    right_key = aside(right_key)
    hot = hot.select(F.col(right_key).alias("__hot"))
    left_is_hot, right_is_hot = F.col(left_key) == F.col("__hot"), F.col(right_key) == F.col("__hot")
    ordinary = left.join(hot, left_is_hot, "left_anti").join(right.join(hot, right_is_hot, "left_anti"), match, "left")
    busy = stash(right.join(hot, right_is_hot, "left_semi"), "hot-rows")
    parts = _parts(busy, right_key)
    placed = busy.withColumn("__part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int"))
    visits = left.join(hot, left_is_hot, "left_semi").withColumn("__visit", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    salted = visits.join(placed, match & (F.col("__visit") == F.col("__part")))
    return ordinary.select(*columns).unionByName(salted.select(*columns))


def _parts(busy: DataFrame, key: str) -> int:
    """Parts of about ``hotGroupRows`` rows for the hottest key."""
    hottest = busy.groupBy(key).agg(F.count("*").alias("__rows")).agg(F.max("__rows")).collect()[0][0] or 1
    return max(2, -(-hottest // max(1, limit(busy.sparkSession, "hotGroupRows"))))


def rows_used(df: DataFrame, key: str, users: DataFrame, user_key: str) -> DataFrame:
    """Rows whose key occurs among the users (``IN``).

    The user side shrinks to its distinct keys before the shuffle, so a key with
    a large share of the rows costs one row per map task.
    """
    seen = users.select(F.col(user_key).alias("__seen")).distinct()
    return df.join(seen, F.col(key) == F.col("__seen"), "left_semi")


def rows_not_in(df: DataFrame, key: str, listed: DataFrame, listed_key: str) -> DataFrame:
    """Rows whose key is not in the list, with SQL's ``NOT IN`` rules for NULL.

    An empty list keeps every row; a NULL in the list keeps none; a NULL key is
    kept only when the list is empty. Spark would plan ``NOT IN`` as a broadcast
    of the list whatever its size, so the rules are spelled out around an
    ordinary anti join. Which rule applies is one scalar subquery over the list.
    """
    nulls = F.count_if(F.col(listed_key).isNull())
    rule = listed.agg(F.when(F.count("*") == 0, "all").when(nulls > 0, "none").otherwise("matching").alias("rule")).scalar()
    seen = listed.select(F.col(listed_key).alias("__seen")).where(F.col("__seen").isNotNull()).distinct()
    keep = (rule == "all") | ((rule == "matching") & F.col(key).isNotNull())
    return df.where(keep).join(seen, F.col(key) == F.col("__seen"), "left_anti")


def orphans(facts: DataFrame, fact_key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Fact rows without a dimension row; a NULL key has none."""
    keys = dimension.select(F.col(dimension_key).alias("__key")).distinct()
    return facts.join(keys, F.col(fact_key) == F.col("__key"), "left_anti")


def repeated_keys(df: DataFrame, key: str, count_name: str, include_null: bool = False) -> DataFrame:
    """Keys on more than one row, optionally also the NULL key; with row counts."""
    bad: Column = F.col(count_name) > 1
    if include_null:
        bad = bad | F.col(key).isNull()
    return df.groupBy(key).agg(F.count("*").alias(count_name)).where(bad)
