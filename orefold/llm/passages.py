"""Near-duplicate passages by compact windows.

A passage is at least ``PASSAGE`` words; its tokens are its 5-word shingles, hashed by
``FUNCTIONS`` hash functions.

1. The Cartesian tree of a text's hashes under one function has a node for every
   shingle: the stretch in which it is the minimum. All passages in that stretch that
   contain the shingle share its value as their signature, so the stretch is one
   compact window for all of them. Only nodes with room for a passage count; they
   are the minima of sliding windows, found for a slice of texts at once, and the
   tree is built over those.
2. Windows of equal value meet in ranges of values. Each is joined to that of the
   smallest document with the value and to that of the document before it, never to
   all. A minimum that many documents hold in different surroundings says little, so
   where three or more documents have a value, windows also meet by value and by
   stretches of words beside the minimum, and each is joined to the smallest document
   of every such group.
3. Per pair of documents the windows of all functions are joined as intervals along
   one shift; stretches on which at least ``AGREEING`` functions agree are candidates.
4. Candidates are verified on the words themselves: parts whose shingles have a Jaccard
   similarity of at least ``SIMILARITY`` percent and that are long enough are passages.

A passage that repeats in another document marks its words as repeated in both, and
as removable in the document with the larger id.

A passage with similarity s is proposed by a function with probability s, so at 0.8
at least two of six functions agree with probability 0.998 for one window per
function; longer passages have more.

Where many documents share the minimum: all members of a group of ``RUNS[0]`` blocks
have 50 words in common, so none is hidden behind another; two documents with 58 or
more words in common always meet in one. With 50 to 57 equal words they meet in a group
of ``RUNS[1]`` blocks (45 words), where a smaller document that has those 45 words but
not 50 can stand before them. Groups of ``RUNS[2]`` blocks are for edited passages and
share 15 words only, so there the hub can be another one. ``similar_parts`` decides on
all of them. Blocks are compared by 8 bits each; a chance match costs a comparison.

Defined cases: null and empty texts and texts shorter than a passage have none; a text
equal to one with a smaller id is removable whole, and both are repeated whole; rows
with equal ids and different texts are separate documents; a null id counts as larger
than all others; repetition within a document does not count; an empty table gives
no rows. Texts are never cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.arrow import append, small_batches
from orefold.llm.packing import first_of_runs, pack, run_starts, united, unpack
from orefold.llm.scratch import Scratch, width
from orefold.llm.words import ALNUM, Texts, Words, grams, mix, text_slices

SHINGLE = 5
PASSAGE = 50
SIMILARITY = 80
FUNCTIONS = 6
AGREEING = 2
_LENGTH = PASSAGE - SHINGLE + 1
# Room two windows must have in common, in shingles: a passage less what may differ.
_ROOM = _LENGTH * SIMILARITY // 100
# Words by which the shift between two texts may vary within a candidate.
DRIFT = 12
# Regions of the smaller document are widened to multiples of this, so that many partners share them.
_STEP = 64
# Blocks of ``SHINGLE`` words at each side of the minimum, as far as a passage reaches.
_SIDE = (_LENGTH - 1) // SHINGLE
# Blocks, that of the minimum included, that windows of one value have in common to meet in a smaller group.
RUNS = (10, 9, 3)
WINDOWS_PER_TASK = 200_000
# Windows that a task gathers before it hands a batch on, and texts that Spark hands it at a time.
BATCH_WINDOWS = 300_000
BATCH_TEXTS = 2_000
# Hashing takes some fifty bytes per byte of text at once.
_SLICE = 1 << 20
_LAST = (1 << 63) - 1
_SALTS = mix(np.arange(1, FUNCTIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOW = np.uint64(0xFFFFFFFF)


def shingles(words: Words, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, word position in the slice, and hash of every shingle."""
    row = np.repeat(np.arange(n_rows), np.diff(words.rows))
    found = grams(words.hashes, SHINGLE)
    at = np.flatnonzero(row[: len(found)] == row[SHINGLE - 1 : SHINGLE - 1 + len(found)])
    return row[at], at, found[at]


def compact_windows(row: np.ndarray, hashes: np.ndarray, length: int = _LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum, first and last index of each compact window with room for ``length``.

    ``hashes`` of several rows stand one after the other. Ties go to the first.
    """
    n = len(hashes) - length + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return none, none, none
    order = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    least, size = order, 1
    while 2 * size <= length:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < length:
        least = np.minimum(least[: len(least) - (length - size)], least[length - size :])
    nodes = np.unique((least & _LOW).astype(np.int64)[row[:n] == row[length - 1 :]])
    if not len(nodes):
        return none, none, none
    # the nearest smaller neighbour of a node with room has room as well, so the tree needs no others
    starts = np.searchsorted(row, row[nodes], "left")
    ends = np.searchsorted(row, row[nodes], "right")
    first, last = starts.tolist(), (ends - 1).tolist()
    at, value, rows = nodes.tolist(), order[nodes].tolist(), row[nodes].tolist()
    stack: list[int] = []
    for i, v in enumerate(value):
        if stack and rows[stack[-1]] != rows[i]:
            stack.clear()
        while stack and value[stack[-1]] > v:
            last[stack.pop()] = at[i] - 1
        if stack:
            first[i] = at[stack[-1]] + 1
        stack.append(i)
    first, last = np.array(first), np.array(last)
    room = last - first + 1 >= length
    return nodes[room], first[room], last[room]


def surroundings(hashes: np.ndarray, node: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A byte for each block beside the minimum of a window, 0 beyond the window."""
    place = node[:, None] + SHINGLE * np.arange(-_SIDE, _SIDE + 1)
    inside = (place >= first[:, None]) & (place <= last[:, None])
    place[~inside] = 0
    return np.where(inside, (hashes[place] >> np.uint64(40)).astype(np.uint8), np.uint8(0))


_BLOBS = "p_range int, p_blob binary"


def _window_blobs(ranges: int):
    def run(batches):
        held: list = []

        def flush():
            value, key, rank, at, left, right, which, beside = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(value, kind="stable")
            value, key, rank, at, left, right, which, beside = (x[order] for x in (value, key, rank, at, left, right, which, beside))
            part = (value >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
            edges = np.searchsorted(part, np.arange(ranges + 1))
            rows = []
            for r in range(ranges):
                s = slice(edges[r], edges[r + 1])
                if edges[r] < edges[r + 1]:
                    texts, one, of = np.unique(key[s], return_index=True, return_inverse=True)
                    steps = np.diff(value[s], prepend=np.uint64(0))
                    numbers = (x[s].astype(np.uint32) for x in (at, left, right))
                    rows.append((r, pack(steps, of.astype(np.uint32), *numbers, which[s], texts, rank[s][one], beside[s].ravel())))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary())], names=["p_range", "p_blob"])

        size = 0
        for batch in batches:
            keys, ranks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for texts in text_slices(batch.column(2), _SLICE):
                words = texts.lower().words(ALNUM)
                row, at, found = shingles(words, len(texts))
                for f, salt in enumerate(_SALTS):
                    value = mix(found ^ salt)
                    node, first, last = compact_windows(row, value)
                    r = row[node]
                    # the values are minima, crowded near 0; mixed again they fill the ranges evenly
                    held.append((mix(value[node]), keys[texts.first + r], ranks[texts.first + r], at[node] - words.rows[r], node - first, last - node, np.full(len(node), f, np.uint8), surroundings(found, node, first, last)))
                    size += len(node)
                if size >= BATCH_WINDOWS:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    return run


_JOINED = "m_key long, m_rank long, h_key long, h_rank long, at int, shift int, lo int, hi int, f int"


def _hubs(starts: np.ndarray, n: int) -> np.ndarray:
    return np.repeat(starts, np.diff(np.append(starts, n)))


def _by_surroundings(value: np.ndarray, left: np.ndarray, right: np.ndarray, beside: np.ndarray):
    """(windows, hubs) of the groups with equal value and equal blocks; windows stand in the order of documents."""
    kinds = [(n, b) for n in RUNS[:2] for b in range(max(0, _SIDE + 1 - n), min(_SIDE, 2 * _SIDE + 1 - n) + 1)]
    kinds += [(RUNS[2], b) for b in range(0, 2 * _SIDE + 2 - RUNS[2], RUNS[2])]
    for n, b in kinds:
        low, high = SHINGLE * (b - _SIDE), SHINGLE * (b + n - 1 - _SIDE)
        inside = np.flatnonzero((left >= -low) & (right >= high))
        if len(inside) < 2:
            continue
        name = value[inside]
        for block in range(b, b + n):
            name = mix(name + beside[inside, block].astype(np.uint64))
        order = np.argsort(name, kind="stable")
        yield inside[order], inside[order[_hubs(run_starts(name[order]), len(order))]]


def _join_windows(table: pa.Table) -> pa.Table:
    """Windows of equal value: each with the smallest document's, the one's before it, and the smallest ones' with the same surroundings."""
    columns: list = [[] for _ in range(8)]
    for blob in table.column("p_blob").to_pylist():
        steps, of, at, left, right, which, texts, ranks, beside = unpack(blob)
        numbers = (at.astype(np.int32), left.astype(np.int32), right.astype(np.int32))
        for c, x in zip(columns, (np.cumsum(steps, dtype=np.uint64), texts[of], ranks[of], *numbers, which, beside.reshape(len(of), -1))):
            c.append(x)
    value, key, rank, at, left, right, which, beside = (np.concatenate(c) for c in columns)
    del columns
    # copies of a text: the smallest id stands for all
    order = np.lexsort((rank, at, key, value))
    order = order[first_of_runs(value[order], key[order], at[order])]
    order = order[np.lexsort((at[order], key[order], rank[order], value[order]))]
    value, key, rank, at, left, right, which, beside = (x[order] for x in (value, key, rank, at, left, right, which, beside))
    starts = run_starts(value)
    hub = _hubs(starts, len(value))
    every = np.arange(len(value))

    def room(i, j):
        return (key[i] != key[j]) & (np.minimum(left[i], left[j]) + np.minimum(right[i], right[j]) + 1 >= _ROOM)

    # the last window of the text before
    own = _hubs(run_starts(value, key), len(value))
    before = np.maximum(own - 1, hub)
    n = len(value)
    pairs = [(every * n + other)[room(every, other)] for other in (hub, before)]
    shared = np.flatnonzero(np.add.reduceat(first_of_runs(value, key).astype(np.int64), starts)[np.cumsum(first_of_runs(value)) - 1] > 2)
    for x, y in _by_surroundings(value[shared], left[shared], right[shared], beside[shared]) if len(shared) else ():
        x, y = shared[x], shared[y]
        pairs.append((x * n + y)[room(x, y)])
    i, j = np.divmod(np.unique(np.concatenate(pairs)), n)
    numbers = [at[i], at[i] - at[j], np.minimum(left[i], left[j]), np.minimum(right[i], right[j]), which[i]]
    return pa.table(
        [pa.array(x) for x in (key[i], rank[i], key[j], rank[j])] + [pa.array(x.astype(np.int32)) for x in numbers],
        names=["m_key", "m_rank", "h_key", "h_rank", "at", "shift", "lo", "hi", "f"],
    )


_REGIONS = "m_key long, m_rank long, m_from long, m_to long, h_key long, h_rank long, h_from long, h_to long"


def _regions(batches):
    """Stretches of a pair on which enough functions agree, in words; the partition has whole pairs."""
    batches = list(batches)
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    m, mr, h, hr, at, shift, lo, hi, f = (c.to_numpy() for c in table.columns)
    order = np.lexsort((at, shift, h, m))
    m, mr, h, hr, at, shift, lo, hi, f = (x[order].astype(np.int64) for x in (m, mr, h, hr, at, shift, lo, hi, f))
    new = first_of_runs(m, h)
    new[1:] |= np.diff(shift) > DRIFT
    cluster = np.cumsum(new)
    start, end = at - lo, at + hi + 1
    order = np.lexsort((start, cluster))
    m, mr, h, hr, shift, f, cluster, start, end = (x[order] for x in (m, mr, h, hr, shift, f, cluster, start, end))
    # running maximum of the ends within a cluster
    span = end.max() + 1
    reach = np.maximum.accumulate(end + cluster * span) - cluster * span
    new = first_of_runs(cluster)
    new[1:] |= start[1:] >= reach[:-1]
    s = np.flatnonzero(new)
    functions = np.bitwise_or.reduceat(np.left_shift(1, f), s)
    agree = np.array([int(x).bit_count() for x in functions]) >= AGREEING
    first, last = start[s], np.maximum.reduceat(end, s) + SHINGLE - 1
    near, far = np.minimum.reduceat(shift, s), np.maximum.reduceat(shift, s)
    h_from = np.maximum(first - far, 0) // _STEP * _STEP
    h_to = -(-(last - near) // _STEP) * _STEP
    columns = [m[s], mr[s], first, last, h[s], hr[s], h_from, h_to]
    yield pa.RecordBatch.from_arrays([pa.array(c[agree]) for c in columns], names=[c.split()[0] for c in _REGIONS.split(", ")])


def _contents(batches):
    """The shingles of each wanted region."""
    for batch in batches:
        keys, first, last = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for texts in text_slices(batch.column(3), _SLICE):
            words = texts.lower().words(ALNUM)
            blobs = []
            for r in range(len(texts)):
                i = texts.first + r
                begin = words.rows[r]
                blobs.append(pack(grams(words.hashes[begin + first[i] : min(begin + last[i], words.rows[r + 1])], SHINGLE)))
            s = slice(texts.first, texts.first + len(texts))
            yield pa.RecordBatch.from_arrays([pa.array(keys[s]), pa.array(first[s]), pa.array(last[s]), pa.array(blobs, pa.binary())], names=["c_key", "c_from", "c_to", "c_grams"])


def similar_parts(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Passages of ``a`` and ``b`` (shingles) that are similar: (start, end, start, end) in shingles."""
    names, which = np.unique(b, return_index=True)
    if not len(names) or not len(a):
        return []
    place = np.searchsorted(names, a)
    place[place == len(names)] = 0
    common = np.flatnonzero(names[place] == a)
    where = which[place][common]
    out: list[tuple[int, int, int, int]] = []

    todo = [(0, len(common))]
    while todo:
        i, j = todo.pop()
        if j <= i or common[j - 1] + 1 - common[i] < _LENGTH:
            continue
        first, last = int(common[i]), int(common[j - 1]) + 1
        low, high = int(where[i:j].min()), int(where[i:j].max()) + 1
        x, y = np.unique(a[first:last]), np.unique(b[low:high])
        both = len(np.intersect1d(x, y, assume_unique=True))
        if both * 100 >= SIMILARITY * (len(x) + len(y) - both):
            out.append((first, last, low, high))
            continue
        # not similar as a whole: cut at the largest gap, of equals the one nearest the middle
        gap = np.abs(np.diff(common[i:j]) - 1) + np.abs(np.diff(where[i:j]) - 1)
        if gap.max(initial=0) > 0:
            widest = np.flatnonzero(gap == gap.max())
            cut = i + 1 + int(widest[np.argmin(np.abs(widest - len(gap) // 2))])
            todo += [(i, cut), (cut, j)]
    return out


_FOUND = "f_key long, f_rank long, f_other long, f_start int, f_end int"


def _verify(batches):
    """Spans (words) of verified passages in both documents, those of one document united."""
    for batch in batches:
        rows: list = []
        m, mr, mf, h, hr, hf = (batch.column(c).to_pylist() for c in ("m_key", "m_rank", "m_from", "h_key", "h_rank", "h_from"))
        a, b = batch.column("m_grams"), batch.column("h_grams")
        for i in range(batch.num_rows):
            for s, e, low, high in similar_parts(unpack(a[i].as_py())[0], unpack(b[i].as_py())[0]):
                rows.append((m[i], mr[i], hr[i], mf[i] + s, mf[i] + e + SHINGLE - 1))
                rows.append((h[i], hr[i], mr[i], hf[i] + low, hf[i] + high + SHINGLE - 1))
        if not rows:
            continue
        key, rank, other, start, end = np.array(sorted(rows, key=lambda x: (x[0], x[1], x[2] > x[1], x[3])), dtype=np.int64).T
        side = other > rank  # spans of one document that others repeat become one; those it repeats stay removable
        out = []
        at = run_starts(key, rank, side)
        for i, j in zip(at, np.append(at[1:], len(key))):
            for s, e in zip(*united(start[i:j], end[i:j])):
                out.append((key[i], rank[i], other[i:j].min(), s, e))
        columns = [pa.array(x, pa.int64()) for x in list(zip(*out))[:3]] + [pa.array(x, pa.int32()) for x in list(zip(*out))[3:]]
        yield pa.RecordBatch.from_arrays(columns, names=["f_key", "f_rank", "f_other", "f_start", "f_end"])


_RESULT = "r_key long, r_repeated long, r_removed long, r_spans string, r_first long"


def _sum_up(batches):
    for batch in batches:
        out = []
        for key, rank, spans in zip(*(c.to_pylist() for c in batch.columns)):
            every = np.array(sorted((s["f_start"], s["f_end"]) for s in spans), dtype=np.int64)
            mine = np.array(sorted((s["f_start"], s["f_end"]) for s in spans if s["f_other"] < rank), dtype=np.int64).reshape(-1, 2)
            start, end = united(every[:, 0], every[:, 1])
            s, e = united(mine[:, 0], mine[:, 1])
            text = ",".join(f"{x}:{y}" for x, y in zip(start, end))
            out.append((key, int((end - start).sum()), int((e - s).sum()), text, min(x["f_other"] for x in spans)))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
        columns = [pa.array([x[c] for x in out], t) for c, t in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["r_key", "r_repeated", "r_removed", "r_spans", "r_first"])


def repeated_passages(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``keep`` with, per document, ``n_words``, ``n_repeated`` and ``n_removed`` words, ``spans``
    (repeated words, from:to, joined by comma), and ``other_id``, the smallest id of a
    document that shares a passage (null if none)."""
    with small_batches(docs.sparkSession, BATCH_TEXTS):
        return _repeated_passages(docs, keep, doc_id, text)


def _repeated_passages(docs: DataFrame, keep: list[str], doc_id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    scratch = Scratch(spark)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    own = [F.xxhash64(body).alias("p_key"), F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_LAST)).alias("p_rank")]

    def count():
        return lambda texts, _: [pa.array(np.diff(texts.lower().words(ALNUM).rows).astype(np.int64))]

    added = T.StructType([T.StructField("p_words", T.LongType())])
    meta = scratch.keep(append(docs, [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), *own], body, added, count), "passage-texts")
    total = meta.agg(F.sum("p_words")).first()[0] or 0
    texts = docs.select(*own, body.alias("p_text"))

    ranges = max(1, -(-total * 2 * FUNCTIONS // ((_LENGTH + 1) * WINDOWS_PER_TASK)))
    windows = texts.mapInArrow(_window_blobs(ranges), _BLOBS)
    joined = scratch.keep(windows.groupBy("p_range").applyInArrow(_join_windows, _JOINED), "passage-windows")
    parts = width(spark, joined.count(), WINDOWS_PER_TASK)
    pairs = scratch.keep(joined.repartition(parts, "m_key", "h_key").mapInArrow(_regions, _REGIONS), "passage-regions")
    scratch.drop(joined)

    wanted = pairs.select(F.col("m_key").alias("w_key"), F.col("m_from").alias("w_from"), F.col("m_to").alias("w_to"))
    wanted = wanted.unionByName(pairs.select(F.col("h_key").alias("w_key"), F.col("h_from").alias("w_from"), F.col("h_to").alias("w_to"))).distinct()
    leaders = meta.groupBy(F.col("p_key").alias("l_key")).agg(F.min("p_rank").alias("l_rank"), F.count(F.lit(1)).alias("l_rows"), F.min(F.when(F.col("p_rank") != F.lit(_LAST), F.col("p_rank"))).alias("l_id"))
    leaders = scratch.keep(leaders, "passage-leaders")
    one = leaders.join(wanted, F.col("l_key") == F.col("w_key")).select("w_key", F.col("l_rank").alias("w_rank"), "w_from", "w_to")
    content = texts.join(one, (F.col("p_key") == F.col("w_key")) & (F.col("p_rank") == F.col("w_rank"))).select("p_key", "w_from", "w_to", "p_text")
    content = scratch.keep(content.mapInArrow(_contents, "c_key long, c_from long, c_to long, c_grams binary"), "passage-contents")
    mine = content.select(F.col("c_key").alias("m_key"), F.col("c_from").alias("m_from"), F.col("c_to").alias("m_to"), F.col("c_grams").alias("m_grams"))
    hubs = content.select(F.col("c_key").alias("h_key"), F.col("c_from").alias("h_from"), F.col("c_to").alias("h_to"), F.col("c_grams").alias("h_grams"))
    both = pairs.join(mine, ["m_key", "m_from", "m_to"]).join(hubs, ["h_key", "h_from", "h_to"])
    found = scratch.keep(both.select("m_key", "m_rank", "m_from", "h_key", "h_rank", "h_from", "m_grams", "h_grams").mapInArrow(_verify, _FOUND), "passage-found")
    scratch.drop(pairs, content)
    spans = found.distinct().groupBy("f_key", "f_rank").agg(F.collect_list(F.struct("f_start", "f_end", "f_other")).alias("spans"))
    result = spans.mapInArrow(_sum_up, _RESULT).groupBy("r_key").agg(*[F.first(c).alias(c) for c in ("r_repeated", "r_removed", "r_spans", "r_first")])

    out = meta.join(leaders, F.col("p_key") == F.col("l_key")).join(result, F.col("p_key") == F.col("r_key"), "left")
    passage = F.col("p_words") >= PASSAGE
    copy = (F.col("p_rank") > F.col("l_rank")) & passage
    copied = (F.col("l_rows") > 1) & passage
    first = F.nullif(F.col("r_first"), F.lit(_LAST))
    return out.select(
        *[F.col("row")[c].alias(c) for c in keep],
        F.col("p_words").alias("n_words"),
        F.when(copied, F.col("p_words")).otherwise(F.coalesce("r_repeated", F.lit(0))).cast("long").alias("n_repeated"),
        F.when(copy, F.col("p_words")).otherwise(F.coalesce("r_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.concat(F.lit("0:"), F.col("p_words"))).otherwise(F.coalesce("r_spans", F.lit(""))).alias("spans"),
        F.when(copy, F.least("l_id", first)).otherwise(first).alias("other_id"),
    )
