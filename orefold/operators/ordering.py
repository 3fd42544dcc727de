"""Dense numbering and look-ahead over a total order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orefold.operators.skew import known_size, measured_stash, same_key, set_aside, short_list, split_hot, with_size
from orefold.session import stash

OCCURRENCE = "occurrence"
_TASK = "__task"
_SEAT = "__seat"
_PLACE = "__place"
# monotonically_increasing_id keeps the partition number above this bit.
_SEAT_BITS = 33


def total_order(columns: list[str], order: list[str], skip: tuple[str, ...] = ()) -> list[Column]:
    """The given order ("-name" is descending), ties broken by the other columns."""
    first = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in order]
    named = {c.lstrip("-") for c in order}
    return first + [F.col(c) for c in columns if c not in named and c not in skip]


def sorted_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows in the given order over all partitions, ties broken by the other columns.

    Copies equal in all columns are told apart by the task they come from, so the
    range sort can divide even a large group of copies among tasks.
    """
    tagged = df.withColumn(_TASK, F.spark_partition_id())
    return tagged.sort(*total_order(df.columns, order), _TASK).drop(_TASK)


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``name``: the 1-based position of each row in the given order.

    Equal to ``row_number() over (order by ...)`` but in parallel: a range sort
    spreads the rows, each task counts its own, and the count of everything
    before a task is added.

    The sorted rows are stored before anything is counted, so both steps see the
    same partitions even if executors are lost in between.
    """
    placed = sorted_rows(df, order).withColumn(_SEAT, F.monotonically_increasing_id())
    stored = measured_stash(placed, "sorted")
    part = F.shiftright(F.col(_SEAT), _SEAT_BITS).cast("int")
    # One row per written partition, so the window and the broadcast hold a few numbers each.
    sizes = stored.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    earlier = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select("__part", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    seat = F.col(_SEAT).bitwiseAND(F.lit((1 << _SEAT_BITS) - 1))
    placed = stored.join(F.broadcast(before), part == F.col("__part"))
    return with_size(placed.select(*df.columns, (F.col("__before") + seat + 1).alias(name)), known_size(stored))


def surrogate_key(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Dense integer key in front of the columns; more than 2^31 rows is an error."""
    numbered = number_rows(df, order, name)
    return with_size(numbered.select(F.col(name).cast("int").alias(name), *df.columns), known_size(numbered))


def stable_key(df: DataFrame, identity: list[str], order: list[str], name: str, known: DataFrame | None) -> DataFrame:
    """Dense integer key in front of the columns, and ``occurrence``, that hold when rows are added.

    A row is known by its ``identity`` and its number among the rows that share it
    (``occurrence``). What ``known`` has (those columns and ``name``) keeps its number;
    other rows get the numbers after the largest known one, in the given order: one
    join on unique keys, and one range sort of the new rows only. Keys of rows that
    are gone are never given again as long as ``known`` has them.
    """
    if known is None:
        placed = number_within(df, identity, order, OCCURRENCE)
        return number_rows(placed, order, name).select(F.col(name).cast("int").alias(name), *df.columns, OCCURRENCE)
    keys = [*identity, OCCURRENCE]
    placed = number_within(df, identity, order, OCCURRENCE)
    found = stash(placed.join(set_aside(known.select(*keys, name), keys), same_key(keys), "left").select(*placed.columns, name), "keyed")
    last = known.agg(F.max(name)).first()[0] or 0
    new = number_rows(found.where(F.col(name).isNull()).drop(name), order, name).withColumn(name, F.col(name) + last)
    both = found.where(F.col(name).isNotNull()).unionByName(new)
    return both.select(F.col(name).cast("int").alias(name), *df.columns, OCCURRENCE)


def number_within(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: ``row_number()`` per key, ties broken by the remaining columns.

    Ordinary keys use a window. Hot keys are numbered together by ``number_rows``
    and shifted by the first position of their key.
    """
    window = W.partitionBy(*keys).orderBy(*total_order(df.columns, order, tuple(keys)))
    cold, hot = split_hot(df, keys)
    numbered = cold.withColumn(name, F.row_number().over(window))
    if hot is None:
        return numbered
    placed = number_rows(hot, [*keys, *order], _PLACE)
    first = set_aside(placed.groupBy(*keys).agg(F.min(_PLACE).alias("__first")), keys)
    shifted = placed.join(short_list(first), same_key(keys)).select(
        *df.columns,
        (F.col(_PLACE) - F.col("__first") + 1).cast("int").alias(name),
    )
    return numbered.unionByName(shifted)


def lead_within(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Add ``name``: ``value`` of the next row of the same key, NULL on the last.

    Ordinary keys use a window. Rows of hot keys are numbered and joined to the
    row one place further on, a join on unique positions.
    """
    window = W.partitionBy(*keys).orderBy(*total_order(df.columns, order, tuple(keys)))
    cold, hot = split_hot(df, keys)
    ahead = cold.withColumn(name, F.lead(value).over(window))
    if hot is None:
        return ahead
    placed = number_rows(hot, [*keys, *order], _PLACE)
    following = set_aside(placed.select(*keys, (F.col(_PLACE) - 1).alias("__before"), F.col(value).alias(name)), keys)
    match = same_key(keys) & (F.col(_PLACE) == F.col("__before"))
    linked = placed.join(following, match, "left").select(*df.columns, name)
    return ahead.unionByName(linked)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], name: str | None = None) -> DataFrame:
    """The first row of each key in the given order.

    The filter on ``row_number() = 1`` lets Spark drop all but one row per key in
    every map task before the shuffle (WindowGroupLimit), so hot keys do not
    matter and need no split. ``name`` keeps the (constant 1) number as a column.
    """
    window = W.partitionBy(*keys).orderBy(*total_order(df.columns, order, tuple(keys)))
    label = name or "__rank"
    ranked = df.withColumn(label, F.row_number().over(window))
    latest = ranked.where(F.col(label) == 1)
    return latest if name else latest.drop(label)
