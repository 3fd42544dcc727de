"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

A source with target T and size S (words) is to be taken T / S times on average. Every
document is first allotted its certain whole copies; for what remains it has an
inclusion probability, and documents are ranked by random odds over inclusion odds,
``(u / (1 - u)) / (p / (1 - p))``. The sample is the head of that order whose size
fits the words left, so its size in words is fixed rather than random. What the last document
that did not fit leaves open is filled by a few further passes over the documents
that still fit, in the same order.

With a ``weight`` column, copies are in proportion to it (unequal probabilities), up
to ``MAX_COPIES``; without one all documents of a source are alike.

The order of a source is never made in one task: the rank, mapped to (0, 1), falls in
one of ``CELLS`` cells, cells are summed first, and sums run on inside a cell.

Defined cases: a null text has size 0 and is never taken; a null source is a source
of its own, after all others; equal rows share their random number, so which of them
is taken does not show; a source without words has target 0; an empty table gives no
rows. Reruns agree, since the random number is a hash of the row. Of a text only its
number of words is kept, so its length does not matter; columns to keep must not begin
with ``m_``, other names clash with nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from orefold.llm.scratch import Scratch

MAX_COPIES = 3
CELLS = 4096
PASSES = 4
SEED = 20250107
_SPACE = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of maximal runs of other than white space."""
    text = F.coalesce(text, F.lit(""))
    return F.size(F.array_remove(F.split(text, _SPACE), "")).cast("long")


def source_targets(sizes: DataFrame, shares: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Target words of each source, from one row per source (``m_source``, ``m_total``).

    Sources in code point order weigh ``shares``, repeating. Targets stop at
    ``MAX_COPIES`` times the size and the excess goes to the others by weight: source
    i gets ``least(MAX_COPIES * size, weight * level)``. The level at which these add
    up to all words lies between two of the ratios size / weight at which a source is
    full, so one running sum over sources in order of that ratio finds it.
    """
    by_name = W.orderBy(F.col("m_source").asc_nulls_last())
    nth = (F.row_number().over(by_name) - 1) % len(shares)
    weighed = sizes.withColumn("m_weight", F.get(F.array(*[F.lit(float(x)) for x in shares]), nth)).withColumn("m_limit", F.col("m_total") * float(MAX_COPIES))
    full_at = F.col("m_limit") / F.col("m_weight")
    order = W.orderBy(F.col("m_full_at"), F.col("m_source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    stepped = (
        weighed.withColumn("m_full_at", full_at)
        .withColumn("m_taken", F.coalesce(F.sum("m_limit").over(before), F.lit(0.0)))
        .withColumn("m_open", F.sum("m_weight").over(every) - F.coalesce(F.sum("m_weight").over(before), F.lit(0.0)))
        .withColumn("m_level", (F.sum("m_total").over(every) - F.col("m_taken")) / F.col("m_open"))
    )
    # the first source that the level does not fill sets it; if all are full, so is the last
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = F.coalesce(F.first(F.when(F.col("m_level") <= F.col("m_full_at"), F.col("m_level")), True).over(whole), F.max("m_full_at").over(whole))
    return stepped.withColumn("m_target", F.least(F.col("m_limit"), F.col("m_weight") * level)).select("m_source", "m_total", "m_target")


def cell(rank: Column, key: Column) -> Column:
    """The part of its source's ranks that a row is in; rows without a rank add nothing to any sum and are dealt out by key."""
    ranked = F.floor(rank / (1 + rank) * CELLS)
    return F.coalesce(ranked, F.pmod(F.xxhash64(key), F.lit(CELLS))).cast("int")


def _running(df: DataFrame, value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of the same source up to this one in rank order."""
    cells = df.groupBy("m_source", "m_cell").agg(F.sum(value).alias("m_sum"))
    ahead = W.partitionBy("m_source").orderBy("m_cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select(F.col("m_source").alias("m_s"), F.col("m_cell").alias("m_c"), F.coalesce(F.sum("m_sum").over(ahead), F.lit(0)).alias("m_ahead"))
    within = W.partitionBy("m_source", "m_cell").orderBy("m_rank", F.col("m_key")).rowsBetween(W.unboundedPreceding, 0)
    return (
        df.join(cells, F.col("m_source").eqNullSafe(F.col("m_s")) & (F.col("m_cell") == F.col("m_c")))
        .withColumn(out, F.col("m_ahead") + F.sum(value).over(within))
        .drop("m_s", "m_c", "m_ahead")
    )


def mixture(docs: DataFrame, size: Column, source: Column, key: Column, keep: list[Column], weight: Column | None = None, shares: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``keep`` with ``m_size``, ``m_total`` and ``m_target`` of the source, and ``m_copies``."""
    scratch = Scratch(docs.sparkSession)
    weight = F.lit(1.0) if weight is None else F.greatest(F.coalesce(weight, F.lit(0.0)), F.lit(0.0))
    rows = scratch.keep(docs.select(*keep, size.alias("m_size"), source.alias("m_source"), key.alias("m_key"), weight.alias("m_weight")), "sizes")
    sizes = rows.groupBy("m_source").agg(F.sum("m_size").alias("m_total"), F.sum(F.col("m_size") * F.col("m_weight")).alias("m_mass"))
    targets = source_targets(sizes.select("m_source", "m_total"), shares)
    masses = sizes.select(F.col("m_source").alias("m_s"), "m_mass")
    targets = targets.join(masses, F.col("m_source").eqNullSafe(F.col("m_s"))).select(F.col("m_source").alias("m_t"), "m_total", "m_target", "m_mass")
    targets = scratch.keep(targets, "targets")

    # copies asked for: in proportion to the weight, MAX_COPIES at most
    asked = F.least(F.lit(float(MAX_COPIES)), F.coalesce(F.col("m_weight") * F.col("m_target") / F.nullif(F.col("m_mass"), F.lit(0.0)), F.lit(0.0)))
    asked = F.when(F.col("m_size") > 0, asked).otherwise(F.lit(0.0))
    chance = F.shiftrightunsigned(F.col("m_key"), 11) / F.lit(float(1 << 53))
    odds = (chance / (1 - chance)) / (F.col("m_part") / (1 - F.col("m_part")))
    ranked = (
        rows.join(targets, F.col("m_source").eqNullSafe(F.col("m_t")))
        .withColumn("m_asked", asked)
        .withColumn("m_copies", F.floor("m_asked").cast("int"))
        .withColumn("m_part", F.col("m_asked") - F.col("m_copies"))
        .withColumn("m_rank", F.when(F.col("m_part") > 0, odds))
        .withColumn("m_cell", cell(F.col("m_rank"), F.col("m_key")))
        .drop("m_t", "m_weight", "m_mass")
    )
    # sizes of rows in question only; whole rows are joined by key at the end
    state = scratch.keep(ranked, "ranked")
    spent = state.groupBy("m_source").agg((F.max("m_target") - F.sum(F.col("m_copies") * F.col("m_size"))).alias("m_left"))
    for _ in range(PASSES):
        left = spent.select(F.col("m_source").alias("m_l"), "m_left")
        open_rows = state.join(left, F.col("m_source").eqNullSafe(F.col("m_l"))).drop("m_l")
        fits = (F.col("m_part") > 0) & (F.col("m_size") > 0) & (F.col("m_size") <= F.col("m_left"))
        summed = _running(open_rows.withColumn("m_try", F.when(fits, F.col("m_size")).otherwise(F.lit(0))), "m_try", "m_run")
        taken = (F.col("m_try") > 0) & (F.col("m_run") <= F.col("m_left"))
        after = (
            summed.withColumn("m_copies", F.col("m_copies") + F.when(taken, 1).otherwise(0))
            .withColumn("m_part", F.when(taken, F.lit(0.0)).otherwise(F.col("m_part")))
            .drop("m_left", "m_try", "m_run")
        )
        before, state = state, scratch.keep(after.select(*before_columns(state)), "ranked")
        scratch.drop(before)
        spent = state.groupBy("m_source").agg((F.max("m_target") - F.sum(F.col("m_copies") * F.col("m_size"))).alias("m_left"))
    scratch.drop(rows, targets)
    return state.drop("m_part", "m_rank", "m_cell", "m_asked", "m_key")


def before_columns(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns]


def row_key(*columns: Column) -> Column:
    """The random number of a row, as 64 bits."""
    return F.xxhash64(*columns, F.lit(SEED))
