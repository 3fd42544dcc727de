"""N-gram Jaccard join by vertical partitioning.

All n-grams have one global order, their 64-bit hashes, cut into ``FRAGMENTS`` equal
ranges. Each set of n-grams is cut at the same places.

1. Equal sets are one class from the start; all later steps are on classes.
2. One fragment prunes: an n-gram of it that only one class has cannot overlap with
   anything, and a class with more such n-grams than any partner allows is alone.
   Only the classes left have all their n-grams spread out.
3. N-grams are put rarest first; two similar classes share one of their first few.
   Every class is paired with one hub per such n-gram, the one that has most of its
   n-grams in common with others. The pairs' overlaps are counted per fragment
   and summed per pair, and components are formed from the links.
4. Pairs across components that can still be similar by their sizes, numbers of
   shared n-grams and places in that order are counted the same way. So copies that
   a hub has already brought together are not paired among each other, and no
   link between two components is missed.

Two classes link when ``100 * overlap >= percent * union``, in whole numbers.

Defined cases: null and empty texts and texts without words have an empty set, which
is linked with nothing; a text shorter than an n-gram is one n-gram; rows with equal
ids are separate documents; null ids are never the smallest unless there is no other;
an empty table gives no rows. Hashes have 64 bits; no text is cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.arrow import append
from orefold.llm.components import components
from orefold.llm.scratch import Scratch
from orefold.llm.words import SPACED, Texts, grams, list_array, mix
from orefold.session import limit

FRAGMENTS = 4
_SALT = np.uint64(0xD6E8FEB86659FD93)


def ngram_sets(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct n-grams of each text, by row and hash."""
    words = texts.lower().words(SPACED)
    counts = np.diff(words.rows)
    row = np.repeat(np.arange(len(texts)), counts)
    found = grams(words.hashes, k)
    at = np.flatnonzero(row[: len(found)] == row[k - 1 : k - 1 + len(found)])
    hashes, rows = [found[at]], [row[at]]
    for n in range(1, k):  # texts shorter than an n-gram
        short = np.flatnonzero(counts == n)
        if len(short):
            whole = grams(words.hashes, n)[words.rows[short]]
            hashes.append(mix(whole + np.uint64(n)))
            rows.append(short)
    h, r = np.concatenate(hashes), np.concatenate(rows)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return r[first], h[first]


def _classes(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and class of each set; equal sets have equal classes."""
    size = np.bincount(row, minlength=n)
    ends = np.concatenate([[0], np.cumsum(size)])
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ s), dtype=np.uint64)]) for s in (np.uint64(0), _SALT)]
    one, two = (s[ends[1:]] - s[ends[:-1]] for s in sums)
    return size, mix(one ^ mix(two + size.astype(np.uint64))).view(np.int64)


_SETS = T.StructType([T.StructField("j_size", T.LongType()), T.StructField("j_class", T.LongType()), T.StructField("j_grams", T.ArrayType(T.LongType()))])


def _work(k: int, fragment: bool):
    def work():
        def made(texts: Texts, _: pa.RecordBatch) -> list[pa.Array]:
            row, h = ngram_sets(texts, k)
            size, cls = _classes(row, h, len(texts))
            if fragment:
                inside = h < np.uint64((1 << 64) // FRAGMENTS)
                row, h = row[inside], h[inside]
            return [pa.array(size.astype(np.int64)), pa.array(cls), list_array(h.view(np.int64), np.bincount(row, minlength=len(texts)), pa.int64())]

        return made

    return work


def _least_overlap(size: Column, percent: int) -> Column:
    """What a set must at least share with any partner."""
    return F.ceil(size * percent / F.lit(100))


def _fragment(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, 62)  # FRAGMENTS = 4 ranges


def _possible(x: str, y: str, percent: int) -> Column:
    """Whether two classes can be similar, by sizes and by numbers of shared n-grams."""
    need = F.col(f"{x}_size") + F.col(f"{y}_size")
    return F.least(f"{x}_shared", f"{y}_shared") * (100 + percent) >= need * percent


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) that are links: overlaps by fragment, summed per pair."""
    cut = sets.select("cls", "size", F.explode("cut").alias("c")).select("cls", "size", F.col("c.f").alias("f"), F.col("c.g").alias("g"))
    left = cut.select(F.col("cls").alias("a"), F.col("size").alias("a_size"), "f", F.col("g").alias("a_grams"))
    right = cut.select(F.col("cls").alias("b"), F.col("size").alias("b_size"), "f", F.col("g").alias("b_grams"))
    partial = pairs.select("a", "b").join(left, "a").join(right, ["b", "f"]).select("a", "b", "a_size", "b_size", F.size(F.array_intersect("a_grams", "b_grams")).alias("n"))
    summed = partial.groupBy("a", "b").agg(F.sum("n").alias("n"), F.first("a_size").alias("a_size"), F.first("b_size").alias("b_size"))
    return summed.where(F.col("n") * (100 + percent) >= (F.col("a_size") + F.col("b_size")) * percent).select("a", "b")


def _broadcast_if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    rows = df.count()
    return F.broadcast(df) if rows * row_bytes <= limit(df.sparkSession, "broadcastBytes") else df


def link_classes(docs: DataFrame, keep: list[str], text: str = "text", k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Documents as (``keep``, ``j_key``, ``j_size``, ``j_class``), and ``node``, ``root`` of every linked class.

    Documents of equal ``j_class`` have equal sets. ``j_key`` is a hash of the text.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    columns = [F.col(f"`{c}`") for c in keep]
    stored = scratch.keep(append(docs, [*columns, F.xxhash64(body).alias("j_key")], body, _SETS, _work(k, True)), "ngram-fragment")

    spread = stored.select("j_class", F.explode("j_grams").alias("gram"))
    lonely = spread.groupBy("gram").agg(F.min("j_class").alias("low"), F.max("j_class").alias("high")).where("low = high").groupBy(F.col("low").alias("cls")).agg(F.count(F.lit(1)).alias("n"))
    every = stored.where("j_size > 0").groupBy(F.col("j_class").alias("cls")).agg(F.min("j_key").alias("key"), F.first("j_size").alias("size"))
    left = scratch.keep(
        every.join(lonely, "cls", "left").where(F.coalesce("n", F.lit(0)) <= F.col("size") - _least_overlap(F.col("size"), percent)).select("key"),
        "ngram-left",
    )

    texts = docs.select(F.xxhash64(body).alias("j_key"), body.alias("j_text"))
    texts = texts.join(_broadcast_if_small(left, 16), F.col("j_key") == F.col("key"), "left_semi").groupBy("j_key").agg(F.first("j_text").alias("j_text"))
    full = append(texts, [], F.col("j_text"), _SETS, _work(k, False)).select(F.col("j_class").alias("cls"), F.col("j_size").alias("size"), F.col("j_grams").alias("grams"))
    full = scratch.keep(full, "ngram-sets")

    each = full.select("cls", "size", F.explode("grams").alias("gram"))
    often = each.groupBy("gram").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    ranked = each.join(often, "gram").groupBy("cls", "size").agg(F.sort_array(F.collect_list(F.struct("often", "gram"))).alias("ranked"))
    shared = F.size("ranked").cast("long")
    kept = ranked.withColumn("shared", shared).withColumn("first", F.col("size") - _least_overlap(F.col("size"), percent) + 1 - (F.col("size") - F.col("shared")))
    grams_of = F.transform("ranked", lambda x: x["gram"])
    cut = F.array(*[F.struct(F.lit(i).alias("f"), F.filter(F.col("all"), _in_fragment(i)).alias("g")) for i in range(FRAGMENTS)])
    kept = kept.where("first > 0").withColumn("all", grams_of).select("cls", "size", "shared", F.slice("all", F.lit(1), F.col("first").cast("int")).alias("head"), cut.alias("cut"))
    sets = scratch.keep(kept, "ngram-ranked")
    scratch.drop(full)

    heads = sets.select("cls", "size", "shared", F.posexplode("head").alias("place", "gram"))
    hub = F.min(F.struct((1 - F.col("shared") / F.col("size")).alias("u"), "cls", "size", "shared"))
    hubs = heads.groupBy("gram").agg(hub.alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select("gram", F.col("hub.cls").alias("y_cls"), F.col("hub.size").alias("y_size"), F.col("hub.shared").alias("y_shared"))
    x = heads.select("gram", "place", F.col("cls").alias("x_cls"), F.col("size").alias("x_size"), F.col("shared").alias("x_shared"))
    starred = x.join(hubs, "gram").where((F.col("x_cls") != F.col("y_cls")) & _possible("x", "y", percent))
    pair = [F.least("x_cls", "y_cls").alias("a"), F.greatest("x_cls", "y_cls").alias("b")]
    tried = scratch.keep(starred.select(*pair).distinct(), "ngram-pairs")
    links = scratch.keep(_verified(tried, sets, percent), "ngram-links")
    roots = scratch.keep(components(links), "ngram-roots")

    placed = x.join(roots, F.col("x_cls") == F.col("node"), "left").withColumn("x_root", F.coalesce("root", "x_cls")).drop("node", "root")
    # a gram whose classes are all linked to each other already leads to no further pair
    mixed = placed.groupBy("gram").agg(F.min("x_root").alias("low"), F.max("x_root").alias("high")).where("low <> high").select("gram")
    placed = placed.join(mixed, "gram", "left_semi")
    other = placed.select("gram", *[F.col(c).alias(f"y{c[1:]}" if c[0] == "x" else f"y_{c}") for c in placed.columns if c != "gram"])
    # what the two can still share from this n-gram on must do
    rest = F.least(F.col("x_shared") - F.col("place"), F.col("y_shared") - F.col("y_place"))
    enough = rest * (100 + percent) >= (F.col("x_size") + F.col("y_size")) * percent
    across = placed.join(other, "gram").where((F.col("x_cls") < F.col("y_cls")) & (F.col("x_root") != F.col("y_root")) & _possible("x", "y", percent) & enough)
    others = scratch.keep(across.select(*pair).distinct().join(tried, ["a", "b"], "left_anti"), "ngram-pairs")
    more = scratch.keep(links.unionByName(_verified(others, sets, percent)), "ngram-links")
    final = scratch.keep(components(more), "ngram-roots")
    scratch.drop(left, sets, tried, links, roots, others, more)
    return stored.drop("j_grams"), final


def _in_fragment(i: int):
    return lambda gram: _fragment(gram) == i


def near_duplicates(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``keep`` with ``j_size``, the set size, and ``j_component``, the smallest id reachable by links."""
    columns = list(dict.fromkeys([*keep, doc_id]))
    rows, roots = link_classes(docs, columns, text, k, percent)
    classes = rows.where("j_size > 0").groupBy(F.col("j_class").alias("cls")).agg(F.min(f"`{doc_id}`").alias("least"))
    rooted = classes.join(roots, F.col("cls") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cls"))
    least = rooted.groupBy(F.col("root").alias("top")).agg(F.min("least").alias("component"))
    named = rooted.join(least, F.col("root") == F.col("top")).select("cls", "component")
    joined = rows.join(named, (F.col("j_class") == F.col("cls")) & (F.col("j_size") > 0), "left")
    return joined.select(*[F.col(f"`{c}`") for c in keep], "j_size", F.when(F.col("j_size") > 0, F.col("component")).otherwise(F.col(f"`{doc_id}`")).alias("j_component"))


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near copies: of each group the one with the smallest id stays.

    Documents without words all stay. Of rows equal in id and text one stays, chosen
    by a hash of the row. Texts are not moved: what goes is found by id and hash of
    the text, and removed by an anti join.
    """
    columns = docs.columns
    scratch = Scratch(docs.sparkSession)
    rows, roots = link_classes(docs, [doc_id], text, k, percent)
    grouped = rows.where("j_size > 0").join(roots, F.col("j_class") == F.col("node"), "left")
    grouped = grouped.select(F.coalesce("root", "j_class").alias("group"), F.col(f"`{doc_id}`").alias("id"), F.col("j_key").alias("key"))
    each = grouped.groupBy("group", "id", "key").agg(F.count(F.lit(1)).alias("rows"))
    best = each.groupBy(F.col("group").alias("g")).agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("best"))
    judged = each.join(best, F.col("group") == F.col("g"))
    stays = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("key") == F.col("best.key"))
    found = scratch.keep(judged.where(~stays | (F.col("rows") > 1)).select("id", "key", stays.alias("stays")), "ngram-going")

    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{doc_id}`").alias("d_id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("d_key"))
    same = F.col("d_id").eqNullSafe(F.col("id")) & (F.col("d_key") == F.col("key"))
    single = keyed.join(_broadcast_if_small(found, 24), same, "left_anti").select("row")
    repeated = keyed.join(_broadcast_if_small(found.where("stays"), 24), same, "left_semi")
    one = repeated.groupBy("d_id", "d_key").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return single.unionByName(one).select(*[F.col("row")[c].alias(c) for c in columns])
