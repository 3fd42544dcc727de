"""Hard-negative mining: the best rows of other labels inside a score window below each positive.

Scores are inner products of whole numbers. An anchor's positives are its first rows of
the same label; for each of them the negatives are the first rows of other labels
whose score lies between two shares of the positive's.

The rows are dealt by label and first coordinate into tiles of bounded size, whatever
share one label or one vector has, since ids part equal ones; a tile is packed into an
R-tree (``rtree``) and stored. The anchors are a stated query set. They are taken in
blocks of bounded size, and a job per block visits all tiles: its tasks keep the best
rows found so far over all their tiles, so that later boxes fall to the prune, and
only the best few per task and query are shuffled and ranked. First come the positives
of the block, then the negatives in the windows that these set. Work per block grows
with the table, and the number of blocks with the anchors.

Through the driver goes one block at a time: ``BLOCK`` anchors on average, with
``positives`` scores each.

Defined cases: rows with a null label or vector, or a null, NaN or infinite component
take no part; shorter vectors are followed by zeros; whole numbers beyond 2^24 count
as 2^24, so scores over up to 256 components are exact; null ids come last among equal scores and are no anchors; a repeated row is
another row, so it can be a positive of its copy, and a repeated anchor has its own
results; a positive with a negative score has no negatives; an empty table, or one
without anchors, gives no rows; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orefold.llm.arrow import small_batches
from orefold.llm.packing import pack, unpack
from orefold.llm.rtree import NO_ID, Queries, Tree, packed_order, search
from orefold.llm.scratch import Scratch
from orefold.llm.shipping import ship
from orefold.llm.vectors import matrix, whole_vectors

SCALE = 256
LARGEST = 1 << 24
# Rows of a tile, and anchors of a block (on average).
TILE = 8192
BLOCK = 4096
# A row's place: its tile's number times this plus its place in the tile.
_PLACES = 1 << 20

_ROWS = "h_id long, h_label long, h_anchor boolean, h_first long, h_width int, h_vector binary"
_TILES = "h_tile long, h_tree binary"
_ANCHORS = "h_row long, h_id long, h_label long, h_vector array<long>"
_FOUND = "h_query long, h_score long, h_id long"


def _usable(rows: DataFrame, row_id: Column, label: Column, vector: Column, anchor: Column, scale: int) -> DataFrame:
    source = rows.select(row_id.cast("long"), label.cast("long"), F.coalesce(anchor, F.lit(False)), vector).toDF("h_id", "h_label", "h_anchor", "h_raw").where("h_label is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, whole, lengths = whole_vectors(batch.column(3), scale, LARGEST)
            data, ends = whole.astype("<i4").tobytes(), np.cumsum(lengths)
            starts = ends - lengths
            blobs = [data[4 * s : 4 * e] for s, e in zip(starts, ends)]
            first = np.where(lengths > 0, whole[np.minimum(starts, max(0, len(whole) - 1))], 0) if len(whole) else np.zeros(len(lengths), dtype=np.int64)
            rest = batch.take(pa.array(good)).columns[:3]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(first), pa.array(lengths, type=pa.int32()), pa.array(blobs, type=pa.binary())], names=[f.split()[0] for f in _ROWS.split(", ")])

    return source.mapInArrow(run, _ROWS)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees of the rows of a task, one per ``TILE`` rows; the number of a tile tells tasks apart."""
    from pyspark import TaskContext

    task, made, held, n = TaskContext.get().partitionId(), 0, [], 0

    def tree(table: pa.Table) -> pa.RecordBatch:
        ids = table["h_id"].combine_chunks().fill_null(NO_ID).to_numpy()
        labels, lengths = table["h_label"].to_numpy(), table["h_width"].to_numpy().astype(np.int64)
        whole = np.frombuffer(b"".join(table["h_vector"].to_pylist()), dtype="<i4").astype(np.int64)
        vectors = matrix(whole, lengths, int(lengths.max()))
        order, starts = packed_order(labels, vectors)
        anchor = table["h_anchor"].to_numpy().astype(np.uint8) & (ids != NO_ID)
        flat = vectors[order].astype(np.int32)
        small = flat.astype(np.int16) if np.abs(flat).max(initial=0) < 1 << 15 else flat
        blob = pack(ids[order], labels[order], anchor[order], starts, small.ravel(), np.array([vectors.shape[1]]))
        return pa.RecordBatch.from_arrays([pa.array([task * 100_000 + made]), pa.array([blob], type=pa.binary())], names=["h_tile", "h_tree"])

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            take = min(TILE - n, batch.num_rows - at)
            held.append(batch.slice(at, take))
            at, n = at + take, n + take
            if n == TILE:
                yield tree(pa.Table.from_batches(held))
                made, held, n = made + 1, [], 0
    if n:
        yield tree(pa.Table.from_batches(held))


def _unpacked(tile: int, blob: bytes) -> tuple[Tree, np.ndarray]:
    ids, labels, anchor, starts, flat, (width,) = unpack(blob)
    return Tree(ids, labels, flat.astype(np.int64).reshape(len(ids), width), starts, tile * _PLACES), anchor


def tiles(rows: DataFrame, row_id: Column, label: Column, vector: Column, anchor: Column, scale: int, scratch: Scratch) -> DataFrame:
    """The usable rows as stored R-trees (``h_tile``, ``h_tree``)."""
    ship(rows.sparkSession)
    parts = max(1, -(-rows.count() // TILE))
    dealt = _usable(rows, row_id, label, vector, anchor, scale).repartitionByRange(parts, "h_label", "h_first", "h_id")
    return scratch.keep(dealt.mapInArrow(_build, _TILES), "tiles")


def _anchors(trees: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                tree, anchor = _unpacked(tile, blob.as_py())
                at = np.flatnonzero(anchor)
                vectors = pa.array(list(tree.vectors[at]), type=pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(at + tree.first_row), pa.array(tree.ids[at]), pa.array(tree.labels[at]), vectors], names=[f.split()[0] for f in _ANCHORS.split(", ")])

    return trees.mapInArrow(run, _ANCHORS)


def _ranked(trees: DataFrame, queries: Queries, k: int) -> DataFrame:
    """The first ``k`` rows of every query over all tiles, with ``h_rank`` from 1."""
    shared = trees.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = shared.value.best(k)
        for batch in batches:
            for tile, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                search(_unpacked(tile, blob.as_py())[0], shared.value, best)
        yield pa.RecordBatch.from_arrays([pa.array(best.query), pa.array(best.score), pa.array(best.id)], names=["h_query", "h_score", "h_id"])

    order = Window.partitionBy("h_query").orderBy(F.desc("h_score"), "h_id")
    return trees.mapInArrow(run, _FOUND).withColumn("h_rank", F.row_number().over(order)).where(F.col("h_rank") <= k)


def _block(trees: DataFrame, anchors: DataFrame, positives: int, low: int, high: int) -> tuple[Queries, np.ndarray, np.ndarray]:
    """The windows of a block's anchors and what stands behind them: ids of the anchors, ids and scores of the positives."""
    block = anchors.orderBy("h_row").toArrow()
    ids = block["h_id"].to_numpy()
    vectors = block["h_vector"].to_pylist()
    lengths = np.array([len(v) for v in vectors], dtype=np.int64)
    whole = np.concatenate([np.array(v, dtype=np.int64) for v in vectors])
    n, width = len(ids), int(lengths.max())
    limits = np.iinfo(np.int64)
    queries = Queries(
        matrix(whole, lengths, width), block["h_label"].to_numpy(), block["h_row"].to_numpy(),
        np.full((n, 1), limits.min + 1), np.full((n, 1), limits.max), True,
    )
    found = _ranked(trees, queries, positives).toArrow()
    at = (found["h_query"].to_numpy(), found["h_rank"].to_numpy() - 1)
    score, who = np.zeros((n, positives), dtype=np.int64), np.full((n, positives), NO_ID)
    there = np.zeros((n, positives), dtype=bool)
    score[at], who[at], there[at] = found["h_score"].to_numpy(), found["h_id"].to_numpy(), True
    # low * positive <= 100 * negative <= high * positive; an empty window where there is no positive
    windows = replace(queries, low=np.where(there, -(-low * score // 100), 1), high=np.where(there, high * score // 100, 0), same=False)
    return windows, ids, np.stack([who, score], axis=2)


def mined(
    rows: DataFrame, row_id: Column, label: Column, vector: Column, anchor: Column,
    positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = SCALE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores for each negative of each positive.

    A negative's score lies between ``low`` and ``high`` hundredths of the positive's.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    trees = tiles(rows, row_id, label, vector, anchor, scale, scratch)
    with small_batches(spark, 4):  # rows are whole trees from here on
        anchors = scratch.keep(_anchors(trees), "anchors")
        blocks = -(-anchors.count() // BLOCK)
        out = None
        for b in range(blocks):
            of_block = anchors.where(F.pmod(F.xxhash64("h_row"), F.lit(blocks)) == b)
            part = _mined_block(spark, trees, of_block, positives, negatives, low, high, schema)
            if part is not None:
                part = scratch.keep(part, "negatives")
                out = part if out is None else out.unionByName(part)
        scratch.drop(trees, anchors)
    return spark.createDataFrame([], schema) if out is None else out


def _mined_block(spark: SparkSession, trees: DataFrame, anchors: DataFrame, positives: int, negatives: int, low: int, high: int, schema: str) -> DataFrame | None:
    if anchors.isEmpty():
        return None
    queries, ids, known = _block(trees, anchors, positives, low, high)
    shared = spark.sparkContext.broadcast((ids, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, known = shared.value
        for batch in batches:
            query, score, negative, rank = (batch.column(i).to_numpy() for i in range(4))
            a, j = query // positives, query % positives
            columns = [ids[a], known[a, j, 0], rank, negative, known[a, j, 1], score]
            arrays = [pa.array(c, mask=(c == NO_ID) if i in (1, 3) else None) for i, c in enumerate(columns)]
            arrays[2] = arrays[2].cast(pa.int32())
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in schema.split(", ")])

    found = _ranked(trees, queries, negatives)
    return found.select("h_query", "h_score", "h_id", "h_rank").mapInArrow(run, schema)
