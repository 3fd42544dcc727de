"""Vector compression: product codes, nearest entries found by sliced bit masks.

A vector of whole numbers is cut into equal parts; a part's code is the index of the
nearest entry in the codebook of its position. Codebooks start as the parts of the
rows with the smallest ids and move in rounds: every part goes to its nearest entry,
every entry to the floor of its parts' mean.

Search in a codebook. Along each coordinate its entries are sorted, and place ``i`` of
that order carries a bit mask of the first ``i`` entries. An initial radius, the
distance to an entry near in the widest coordinate, cuts a range from each order; the
masks at its two ends differ in exactly the entries inside. ANDing these over the
coordinates leaves the entries in the box around the part, among them all at the
radius or nearer, so the nearest of them is the nearest of all.

A round is one job: tasks add up sums and counts of their parts, and a number per
part position, entry and component comes back, whatever the size of the table. The
codebooks go out with the next round's tasks. Nothing else is kept between rounds.

Defined cases: rows with a null vector or a null, NaN or infinite component are
dropped; shorter vectors are followed by zeros up to the longest, and the last part
too where the length is no multiple of the parts; whole numbers beyond 2^27 count as
2^27, so distances over up to 64 components a part are exact; of equal ids the smaller vector comes first, null ids last; fewer rows than
entries give smaller codebooks; repeated rows count as often as they stand there;
rows with equal labels share a label error, null labels together; an empty table
gives no rows; extra columns pass through ``keep``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.scratch import Scratch
from orefold.llm.shipping import ship
from orefold.llm.vectors import matrix, whole_vectors
from orefold.operators.skew import measure
from orefold.session import limit

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LARGEST = 1 << 27
# Pairs of a part and a candidate compared at once.
_PAIRS = 1 << 19


class Codebook:
    """Entries of one part position, sliced for exact search."""

    def __init__(self, entries: np.ndarray):
        k, d = entries.shape
        self.entries = entries
        self.orders = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.orders, axis=0)
        words = -(-k // 64)
        own = np.zeros((k, words), dtype=np.uint64)
        own[np.arange(k), np.arange(k) // 64] = np.uint64(1) << (np.arange(k) % 64).astype(np.uint64)
        self.prefix = np.zeros((d, k + 1, words), dtype=np.uint64)
        for j in range(d):
            self.prefix[j, 1:] = np.bitwise_or.accumulate(own[self.orders[:, j]], axis=0)
        self.widest = int(np.argmax(self.sorted[-1] - self.sorted[0])) if d else 0

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """A bit per entry: whether it differs by at most ``radius`` in every component."""
        mask = np.full((len(x), self.prefix.shape[2]), ~np.uint64(0))
        for j in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, j], x[:, j] - radius, "left")
            high = np.searchsorted(self.sorted[:, j], x[:, j] + radius, "right")
            mask &= self.prefix[j, high] ^ self.prefix[j, low]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, ties to the lower one, and its squared distance."""
        k, step = len(self.entries), max(1, _PAIRS // len(self.entries))
        found = [self._nearest(x[i : i + step], k) for i in range(0, len(x), step)]
        if not found:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _nearest(self, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if x.shape[1] == 0:
            return np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
        w = self.widest
        at = np.minimum(np.searchsorted(self.sorted[:, w], x[:, w]), k - 1)
        first = self.entries[self.orders[at, w]]
        reach = ((x - first) ** 2).sum(axis=1)
        radius = np.ceil(np.sqrt(reach.astype(np.float64))).astype(np.int64) + 1
        mask = self.candidates(x, radius)
        bits = np.unpackbits(mask.astype("<u8").view(np.uint8), axis=1, count=k, bitorder="little")
        row, entry = np.nonzero(bits)
        distance = ((x[row] - self.entries[entry]) ** 2).sum(axis=1)
        starts = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(distance, starts)
        hits = np.flatnonzero(distance == least[row])
        # pairs stand by row and entry: the first hit of a row is the lowest entry
        return entry[hits[np.searchsorted(row[hits], np.arange(len(x)))]], least


@dataclass
class Books:
    """Codebooks of all part positions: ``entries[part, entry, component]``."""

    entries: np.ndarray
    width: int

    def parts(self, whole: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        p, _, d = self.entries.shape
        return matrix(whole, np.minimum(lengths, p * d), p * d).reshape(len(lengths), p, d)

    def assign(self, parts: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
        found = [book.nearest(parts[:, p]) for p, book in enumerate(books)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def searched(self) -> list[Codebook]:
        return [Codebook(e) for e in self.entries]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def first_books(rows: DataFrame, vector: Column, row_id: Column, parts: int, entries: int, scale: int) -> Books | None:
    """Codebooks from the rows with the smallest ids; None without a usable row."""
    schema = "b_id long, b_vector array<long>, b_width long"

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, whole, lengths = whole_vectors(batch.column(1), scale, LARGEST)
            if not len(good):
                continue
            ids = batch.column(0).take(pa.array(good))
            width = int(lengths.max())
            known = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
            values = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
            # all rows up to the last id that can be among the first: equal ids compare by vector
            last = np.partition(values, min(entries, len(values)) - 1)[min(entries, len(values)) - 1]
            near = np.flatnonzero(values <= last)
            rows_ = matrix(whole, lengths, width)[near]
            order = np.lexsort((*rows_.T[::-1], values[near], ~np.isin(near, known)))[:entries]
            starts = np.cumsum(lengths) - lengths
            chosen = near[order]
            vectors = [whole[starts[i] : starts[i] + lengths[i]] for i in chosen]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(chosen)), pa.array(vectors, type=pa.list_(pa.int64())), pa.array([width] * len(chosen))], names=["b_id", "b_vector", "b_width"])

    seen = Observation()
    found = rows.select(row_id.cast("long").alias("b_id"), vector.alias("b_vector")).mapInArrow(heads, schema).observe(seen, F.max("b_width").alias("width"))
    chosen = found.orderBy(F.asc_nulls_last("b_id"), "b_vector").limit(entries).select("b_vector").collect()
    if not chosen:
        return None
    width = int(seen.get["width"])
    whole = [np.array(r.b_vector, dtype=np.int64) for r in chosen]
    books = Books(np.zeros((parts, len(whole), -(-width // parts)), dtype=np.int64), width)
    books.entries = books.parts(np.concatenate(whole), np.array([len(v) for v in whole])).transpose(1, 0, 2).copy()
    return books


def moved(rows: DataFrame, vector: Column, books: Books, scale: int) -> Books:
    """The codebooks after one round over all rows."""
    parts, entries, d = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = books.searched()
        total = np.zeros((parts, entries, d + 1), dtype=np.int64)
        for batch in batches:
            _, whole, lengths = whole_vectors(batch.column(0), scale, LARGEST)
            x = books.parts(whole, lengths)
            code, _ = books.assign(x, searched)
            for p in range(parts):
                total[p, :, d] += np.bincount(code[:, p], minlength=entries)
                for j in range(d):
                    # sums of a batch stay below 2^53
                    total[p, :, j] += np.bincount(code[:, p], x[:, p, j], entries).astype(np.int64)
        at = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["m_at", "m_sum"])

    found = rows.select(vector.alias("m_vector")).mapInArrow(sums, "m_at long, m_sum long")
    total = np.zeros(parts * entries * (d + 1), dtype=object)
    # one row per component of an entry
    for at, value in found.groupBy("m_at").agg(F.sum(F.col("m_sum").cast("decimal(38,0)"))).collect():
        total[at] = int(value)
    total = total.reshape(parts, entries, d + 1)
    used = total[:, :, d] > 0
    new = books.entries.copy()
    new[used] = (total[used][:, :d] // total[used][:, d:]).astype(np.int64)
    return Books(new, books.width)


def fit(rows: DataFrame, vector: Column, row_id: Column, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Books | None:
    """Codebooks after ``rounds`` rounds over the whole table."""
    ship(rows.sparkSession)
    books = first_books(rows, vector, row_id, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = moved(rows, vector, books, scale)
    return books


def _hex(code: np.ndarray, entries: int) -> pa.Array:
    """Codes as text, two hex digits each, more for codebooks above 256 entries."""
    digits = max(2, (len(f"{entries - 1:x}") + 1) // 2 * 2)
    n, parts = code.shape
    shifts = np.arange(digits - 1, -1, -1) * 4
    chars = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)[code[:, :, None] >> shifts & 15]
    offsets = np.arange(n + 1, dtype=np.int32) * (parts * digits)
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(chars)))


def encoded(rows: DataFrame, books: Books | None, keep: list[Column], vector: Column, scale: int = SCALE) -> DataFrame:
    """``keep``, ``v_code`` and ``v_error``, the squared distance to the coded vector, of every usable row."""
    ship(rows.sparkSession)
    source = rows.select(*keep, vector.alias("__vector"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("v_code", T.StringType()), T.StructField("v_error", T.LongType())])
    if books is None:
        return rows.sparkSession.createDataFrame([], schema)
    names = [f.name for f in schema]

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = books.searched()
        for batch in batches:
            good, whole, lengths = whole_vectors(batch.column(batch.num_columns - 1), scale, LARGEST)
            code, distance = books.assign(books.parts(whole, lengths), searched)
            rest = batch.take(pa.array(good)).columns[:-1]
            yield pa.RecordBatch.from_arrays([*rest, _hex(code, books.entries.shape[1]), pa.array(distance.sum(axis=1))], names=names)

    return source.mapInArrow(codes, schema)


def compressed(rows: DataFrame, keep: list[Column], vector: Column, row_id: Column, label: Column, **settings: int) -> DataFrame:
    """``keep`` with ``v_code``, ``v_error``, ``v_label_error`` (summed over rows of the label) and ``v_books`` (a hash of the codebooks)."""
    books = fit(rows, vector, row_id, **settings)
    coded = encoded(rows, books, [F.struct(*keep).alias("v_row"), label.alias("v_label")], vector, settings.get("scale", SCALE))
    coded = Scratch(rows.sparkSession).keep(coded, "codes")
    totals = coded.groupBy(F.col("v_label").alias("t_label")).agg(F.sum("v_error").alias("v_label_error"))
    if measure(totals)[1] <= limit(rows.sparkSession, "broadcastBytes"):
        totals = F.broadcast(totals)
    joined = coded.join(totals, F.col("v_label").eqNullSafe(F.col("t_label")))
    return joined.select("v_row.*", "v_code", "v_error", "v_label_error", F.lit(books.sha256() if books else None).alias("v_books"))
