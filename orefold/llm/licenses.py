"""License scans by diagonal voting.

Texts are read once: of the rolling hashes of ``GRAM`` words those that occur in any
template are kept with their position (the templates are a fixed list, a few hundred
hashes). These are joined to the template positions; each pair votes for a diagonal,
text position less template position. Votes are counted per text, template and
diagonal; neighbouring diagonals (at most ``DRIFT`` words apart, as an inserted or
missing word leaves them) are merged, and a merged span counts if the template words
found in it are at least ``SHARE`` of the template and it is not stretched. A diagonal
that has the whole template is a span of its own, and a run that is stretched is split
into its diagonals. Of two spans that overlap, one is dropped only if it has more breaks
(words changed, inserted or missing) inside the other than the other has inside it.

A base phrase is a template of which every word must stand on one diagonal.

Defined cases: null and empty texts have no words and no labels; texts are keyed by
their content, so copies are scanned for votes once; rows may repeat; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from orefold.llm.arrow import append
from orefold.llm.scratch import Scratch
from orefold.llm.words import ALNUM, Texts, grams, list_array, text_slices

GRAM = 2
DRIFT = 3
SHARE = 0.75
# Words of a stretch of text; no span is longer.
_STRETCH = 64

# Phrases of the base definition and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Wording of common license notices, and labels.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("licensed under the gnu general public license version 2", "gpl-2.0"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("creative commons attribution", "cc-by"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)


def _hashes(text: str) -> np.ndarray:
    return next(text_slices(pa.array([text]))).words(ALNUM).hashes


def templates() -> list[tuple[int, str, bool, int, int, int]]:
    """(template, label, base, words, position, gram) of every template gram."""
    rows = []
    for t, (text, label) in enumerate([*PHRASES, *NOTICES]):
        words = _hashes(text)
        rows += [(t, label, t < len(PHRASES), len(words), p, int(g)) for p, g in enumerate(grams(words, GRAM).view(np.int64))]
    return rows


def _scan(wanted: np.ndarray):
    def work():
        def made(texts: Texts, _: pa.RecordBatch) -> list[pa.Array]:
            words = texts.lower().words(ALNUM)
            counts = np.diff(words.rows)
            row = np.repeat(np.arange(len(texts)), counts)
            found = grams(words.hashes, GRAM)
            at = np.flatnonzero(np.isin(found, wanted))
            at = at[row[at] == row[at + GRAM - 1]]
            pairs = pa.StructArray.from_arrays([pa.array(at - words.rows[row[at]]), pa.array(found[at].view(np.int64))], names=["at", "gram"])
            return [pa.array(counts.astype(np.int64)), list_array(pairs, np.bincount(row[at], minlength=len(texts)), pairs.type)]

        return made

    return work


def _breaks(hits: Column, words: Column) -> Column:
    """(last right word before, first after) of each place, in the text, where the words leave the template."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(hits)), lambda i: F.struct(F.element_at(hits, i).alias("a"), F.try_element_at(hits, i + 1).alias("b")))
    apart = F.filter(pairs, lambda p: (p["b"]["place"] - p["a"]["place"] != 1) | (p["b"]["at"] - p["a"]["at"] != 1))
    inner = F.transform(apart, lambda p: F.struct((p["a"]["at"] + 1).alias("low"), p["b"]["at"].alias("high")))
    first, last = F.element_at(hits, 1), F.element_at(hits, -1)
    none = F.filter(inner, lambda _: F.lit(False))
    head = F.when(first["place"] > 0, F.array(F.struct((first["at"] - 1).alias("low"), first["at"].alias("high")))).otherwise(none)
    tail = F.when(last["place"] + GRAM < words, F.array(F.struct((last["at"] + 1).alias("low"), (last["at"] + 2).alias("high")))).otherwise(none)
    return F.concat(head, inner, tail)


def _inside(breaks: Column, start: Column, end: Column) -> Column:
    return F.size(F.filter(breaks, lambda b: (b["low"] >= start) & (b["high"] < end)))


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents (``keep``, ``l_key``, ``l_words``) and the license spans of each ``l_key``.

    Spans: ``label``, ``base``, ``start`` and ``end`` in words, ``share`` of the template found.
    """
    spark = docs.sparkSession
    rows = templates()
    listed = spark.createDataFrame(rows, "template int, label string, base boolean, words int, place int, gram long")
    wanted = np.unique(np.array([r[5] for r in rows], dtype=np.int64).view(np.uint64))
    added = T.StructType([T.StructField("l_words", T.LongType()), T.StructField("l_hits", T._parse_datatype_string("array<struct<at:long,gram:long>>"))])
    body = F.col(f"`{text}`")
    scanned = append(docs, [*[F.col(f"`{c}`") for c in keep], F.xxhash64(F.coalesce(body, F.lit(""))).alias("l_key")], body, added, _scan(wanted))
    scanned = Scratch(spark).keep(scanned, "license-hits")
    once = scanned.where(F.size("l_hits") > 0).groupBy("l_key").agg(F.first("l_hits").alias("l_hits"))
    votes = once.select("l_key", F.explode("l_hits").alias("h")).select("l_key", "h.at", "h.gram").join(F.broadcast(listed), "gram")
    diagonals = (
        votes.groupBy("l_key", "template", "label", "base", "words", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(F.min("at").alias("start"), (F.max("at") + GRAM).alias("end"), F.collect_set("place").alias("places"))
    )
    exact = diagonals.where("base and size(places) = words - 1").select("l_key", "label", "base", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("words")).alias("end"), F.lit(1.0).alias("share"))
    order = W.partitionBy("l_key", "template").orderBy("diagonal")
    found = ["l_key", "template", "label", "base", "words", "start", "end", "hits"]
    diagonals = diagonals.where("not base").withColumn("hits", F.transform("places", lambda p: F.struct(p.alias("place"), (p + F.col("diagonal")).alias("at"))))
    whole = F.size("places") == F.col("words") - 1
    runs = (
        diagonals.where(~whole)
        .withColumn("apart", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT, F.lit(True)).cast("int"))
        .withColumn("run", F.sum("apart").over(order))
        .groupBy("l_key", "template", "label", "base", "words", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.flatten(F.collect_list("hits")).alias("hits"), F.collect_list(F.struct("start", "end", "hits")).alias("parts"))
    )
    stretched = F.col("end") - F.col("start") > F.col("words") * (2 - SHARE) + DRIFT
    split = runs.where(stretched).select(*found[:5], F.inline("parts"))
    merged = diagonals.where(whole).select(*found).unionByName(runs.where(~stretched).select(*found)).unionByName(split)
    covered = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.array(h["place"], h["place"] + 1)))))
    near = merged.withColumn("share", covered / F.col("words")).where(F.col("share") >= SHARE).withColumn("hits", F.array_sort("hits"))
    near = Scratch(spark).keep(near.withColumn("breaks", _breaks(F.col("hits"), F.col("words"))).drop("hits"), "license-spans")
    # wordings that differ in a word match the same place; spans are joined by stretches of the text, each with those near it
    stretch = F.floor(F.col("start") / _STRETCH)
    others = near.select(F.col("l_key").alias("o_key"), F.col("template").alias("o_template"), F.col("start").alias("o_start"), F.col("end").alias("o_end"), F.col("breaks").alias("o_breaks"), F.explode(F.sequence(stretch - 1, stretch + 1)).alias("o_stretch"))
    better = (
        (F.col("l_key") == F.col("o_key")) & (stretch == F.col("o_stretch")) & (F.col("template") != F.col("o_template"))
        & (F.col("start") < F.col("o_end")) & (F.col("o_start") < F.col("end"))
        & (_inside(F.col("breaks"), F.col("o_start"), F.col("o_end")) > _inside(F.col("o_breaks"), F.col("start"), F.col("end")))
    )
    near = near.join(others, better, "left_anti").select("l_key", "label", "base", "start", "end", "share")
    return scanned.drop("l_hits"), exact.unionByName(near)


def labelled(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, ``n_words``, and what the spans of each document come to."""
    scanned, spans = scan(docs, keep, text)
    base = F.col("base")
    summed = spans.groupBy(F.col("l_key").alias("l_with")).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    return scanned.join(summed, F.col("l_key") == F.col("l_with"), "left").select(
        *[F.col(f"`{c}`") for c in keep],
        F.col("l_words").alias("n_words"),
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
    )
