"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item, or the whole item if it
is shorter. Of every ``WINDOW`` words in a row the 5-gram with the smallest hash is
kept as a fingerprint, on both sides; equal windows keep equal fingerprints, so every
shared window shows as a shared fingerprint. Each such hit is extended over the
windows that contain it, word by word. Items shorter than a window have no such
guarantee and are looked up whole, at every word.

The benchmark goes to the tasks in blocks of at most ``BLOCK_BYTES`` of text (or one
longer item), each block a further pass over the documents in place: no document is
shuffled, joined or moved, and no hot passage gathers anywhere.

Defined cases: null texts and texts without words have no hits; a null item id is
reported as the empty string; items with equal ids count as one, and repeated rows are read once; rows with equal ids
are judged one by one; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.arrow import append
from orefold.llm.words import ALNUM, Texts, grams, list_array, text_slices

WINDOW = 10
GRAM = 5
BLOCK_BYTES = 16 << 20
# Pairs of a document's and an item's fingerprint that are extended at once.
PAIRS = 200_000
ADDED = T.StructType(
    [
        T.StructField("d_words", T.LongType()),
        T.StructField("d_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("d_items", T.ArrayType(T.StringType())),
    ]
)


def fingerprints(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and hashes of the grams kept by winnowing within each row."""
    found = grams(hashes, GRAM)
    per_window = WINDOW - GRAM + 1
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), found[:0]
    least, at = found[:n].copy(), np.arange(n)
    for i in range(1, per_window):
        other = found[i : i + n]
        lower = other <= least  # the last of equals, so that equal windows agree
        least[lower] = other[lower]
        at[lower] = np.flatnonzero(lower) + i
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    at = np.unique(at[row[:n] == row[WINDOW - 1 : WINDOW - 1 + n]])
    return at, found[at]


class Items:
    """A block of the benchmark, ready for look-up."""

    def __init__(self, ids: list[str], texts: list[str]):
        self.ids = np.array(ids, dtype=object)
        words = next(text_slices(pa.array(texts, type=pa.large_string())), None) if sum(map(len, texts)) < 1 << 20 else None
        parts = [words] if words is not None and len(words) == len(texts) else list(text_slices(pa.array(texts, type=pa.large_string())))
        hashes, lengths = [], []
        for part in parts:
            w = part.lower().words(ALNUM)
            hashes.append(w.hashes)
            lengths.append(np.diff(w.rows))
        self.hashes = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
        lengths = np.concatenate(lengths) if lengths else np.empty(0, dtype=np.int64)
        self.rows = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        self.row = np.repeat(np.arange(len(ids)), lengths)
        at, prints = fingerprints(self.hashes, self.rows)
        order = np.argsort(prints, kind="stable")
        self.prints, self.at = prints[order], at[order]
        self.short = {}
        for n in range(1, WINDOW):
            items = np.flatnonzero(lengths == n)
            if len(items):
                whole = np.array([grams(self.hashes[self.rows[i] : self.rows[i + 1]], n)[0] for i in items], dtype=np.uint64)
                order = np.argsort(whole, kind="stable")
                self.short[n] = (whole[order], items[order])


def _ranges(first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each i, the pairs (i, j) with j from first[i] to last[i], ``PAIRS`` of them at a time."""
    ends = np.cumsum(last - first)
    total = int(ends[-1]) if len(ends) else 0
    for low in range(0, total, PAIRS):
        nth = np.arange(low, min(low + PAIRS, total))
        i = np.searchsorted(ends, nth, "right")
        yield i, last[i] - (ends[i] - nth)


def _windows(block: Items, hashes: np.ndarray, rows: np.ndarray, row: np.ndarray):
    """Hit windows as (start, length, item)."""
    at, prints = fingerprints(hashes, rows)
    for which, j in _ranges(np.searchsorted(block.prints, prints, "left"), np.searchsorted(block.prints, prints, "right")):
        p, q = at[which], block.at[j]
        item, doc = block.row[q], row[p]
        reach = np.arange(-(WINDOW - GRAM), WINDOW)
        a, b = p[:, None] + reach, q[:, None] + reach
        inside = (a >= rows[doc][:, None]) & (a < rows[doc + 1][:, None]) & (b >= block.rows[item][:, None]) & (b < block.rows[item + 1][:, None])
        same = inside & (hashes[a.clip(0, len(hashes) - 1)] == block.hashes[b.clip(0, len(block.hashes) - 1)])
        for i in range(WINDOW - GRAM + 1):
            ok = same[:, i : i + WINDOW].all(axis=1)
            yield a[ok, i], WINDOW, item[ok]
    for n, (whole, items) in block.short.items():
        found = grams(hashes, n)
        start = np.flatnonzero(row[: len(found)] == row[n - 1 : n - 1 + len(found)])
        start = start[np.isin(found[start], whole)]
        for which, j in _ranges(np.searchsorted(whole, found[start], "left"), np.searchsorted(whole, found[start], "right")):
            yield start[which], n, items[j]


def _scan(shared, before: bool):
    def work():
        block: Items = shared.value

        def made(texts: Texts, rest: pa.RecordBatch) -> list[pa.Array]:
            words = texts.lower().words(ALNUM)
            rows, counts = words.rows, np.diff(words.rows)
            row = np.repeat(np.arange(len(texts)), counts)
            edge = np.zeros(len(row) + 1, dtype=np.int64)
            named: list[set] = [set() for _ in range(len(texts))]
            if before:
                spans, items = rest.column(rest.num_columns - 3), rest.column(rest.num_columns - 2)
                of = np.repeat(np.arange(len(texts)), spans.value_lengths().to_numpy(zero_copy_only=False))
                flat = spans.flatten()
                np.add.at(edge, rows[of] + flat.field("start").to_numpy(), 1)
                np.add.at(edge, rows[of] + flat.field("end").to_numpy(), -1)
                for r, found in enumerate(items.to_pylist()):
                    named[r].update(found)
            for start, n, item in _windows(block, words.hashes, rows, row):
                np.add.at(edge, start, 1)
                np.add.at(edge, start + n, -1)
                for r, i in np.unique(np.stack([row[start], item]), axis=1).T if len(start) else ():
                    named[r].add(block.ids[i])
            hit = np.cumsum(edge[:-1]) > 0
            first, last = hit.copy(), hit.copy()
            first[1:] &= ~(hit[:-1] & (row[1:] == row[:-1]))
            last[:-1] &= ~(hit[1:] & (row[1:] == row[:-1]))
            s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
            of = row[s]
            pairs = pa.StructArray.from_arrays([pa.array(s - rows[of]), pa.array(e - rows[of])], names=["start", "end"])
            return [
                pa.array(counts.astype(np.int64)),
                list_array(pairs, np.bincount(of, minlength=len(texts)), pairs.type),
                pa.array([sorted(x) for x in named], type=pa.list_(pa.string())),
            ]

        return made

    return work


def hits(docs: DataFrame, keep: list[str], text: str, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``keep`` with ``d_words`` (words), ``d_spans`` (hit words, end exclusive) and ``d_items`` (ids)."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    items = items.distinct()
    measured = items.agg(F.sum(F.octet_length("t") + F.octet_length("i") + 64).alias("n")).first()["n"] or 0
    blocks = -(-measured // BLOCK_BYTES) or 1
    columns = [F.col(f"`{c}`") for c in keep]
    body = F.col(f"`{text}`")
    found = docs
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).toArrow() if blocks > 1 else items.toArrow()
        shared = spark.sparkContext.broadcast(Items(rows["i"].to_pylist(), rows["t"].to_pylist()))
        extra = [] if text in keep else [body]
        if b == 0:
            found = append(found, columns + extra, body, ADDED, _scan(shared, False))
        else:
            now = [F.col(c).alias(f"{c}_before") for c in ("d_spans", "d_items")]
            renamed = found.select(*columns, *extra, *now)
            found = append(renamed, columns + extra + [F.col("d_spans_before"), F.col("d_items_before")], body, ADDED, _scan(shared, True))
    return found.select(*columns, "d_words", "d_spans", "d_items")


def hit_words() -> Column:
    return F.aggregate("d_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
