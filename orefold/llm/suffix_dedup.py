"""Exact substring deduplication by a distributed merge sort of suffixes.

Every ``LENGTH``-byte string that also starts in a document with a smaller id is
removed. Not every suffix is sorted: of each ``LENGTH`` bytes the ``SEED``-byte gram
with the smallest hash is an anchor, so equal strings have equal anchors at equal
places, and each string is found at the anchor it selects.

1. Anchors whose gram occurs in one text only are dropped: hashes go to ranges, packed
   a few bytes each, and come back as the places that remain.
2. For what remains, the suffix at the anchor (``LENGTH`` bytes, then the bytes before
   the anchor, backwards) joins a sorted run of its task. Runs are cut at splitters
   and exchanged front-coded: of each suffix only what differs from the one before.
3. A task merges its runs with a loser tree that carries the length of the common
   prefix with the last winner: of two candidates the one with the longer prefix is
   smaller without looking at a byte; others are compared as one number each. The result
   is the sorted order with its common prefixes, in which all suffixes sharing their
   first n bytes are neighbours. All runs are decoded at once, since their number grows
   with the texts.
4. For each offset of a string before its anchor, the smallest id among the suffixes that
   agree on the bytes after and before the anchor decides; the removed strings of a
   suffix all cover the anchor and make one interval. A partition packs its intervals
   by bucket of texts, where those of a text meet.

A gram found in more than ``HOT_TEXTS`` texts is not merged in one task: its strings
are hashed and get their smallest id by a grouped minimum, combined before the shuffle,
and a join. Where a sample of texts shows such grams beforehand, they never meet in
step 1 either: their places go on by text. Both ways give the same result, so the sample
only deals out work. Copies of a text within a task are united before anything is
shuffled.

Defined cases: null and empty texts have no bytes; texts shorter than ``LENGTH`` keep
all; a text equal to one with a smaller id is removed whole; rows with equal ids do
not remove each other; a null id counts as larger than all others and null ids as
equal; an empty table gives no rows. Texts are never cut.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.llm.arrow import small_batches
from orefold.llm.packing import first_of_runs, pack, run_starts, united, unpack
from orefold.llm.scratch import Scratch
from orefold.llm.words import _BASE, mix, text_slices

LENGTH = 50
SEED = 16
OFFSETS = LENGTH - SEED + 1
WIDTH = LENGTH + OFFSETS - 1
HOT_TEXTS = 200_000
# Anchors of a range, and suffixes of a partition, that a task holds at once.
ANCHORS_PER_TASK = 250_000
SUFFIXES_PER_TASK = 150_000
# Ranges, buckets and partitions beyond which they grow instead, and how many times larger they may get:
# every batch is cut into all of them, so the pieces grow with the square of the texts.
MANY_PIECES = 128
MOST_ANCHORS, MOST_SUFFIXES, MOST_BYTES = 4, 2, 2
# Anchors and suffixes that a task gathers before it hands a batch on.
BATCH_ANCHORS = 1_000_000
# Texts that a task remembers, to leave out their copies.
SEEN_TEXTS = 500_000
BATCH_SUFFIXES = 150_000
# Bytes of text whose places are brought together at once.
BUCKET_BYTES = 16 << 20
# Texts that Spark hands to a task at a time.
BATCH_TEXTS = 2_000
# Hashing takes some fifty bytes per byte of text at once.
_SLICE = 1 << 20
# Texts, and suffix heads of theirs, from which splitters are chosen.
SAMPLED_TEXTS = 4_000
SAMPLED_HEADS = 100_000
_LAST = (1 << 63) - 1


def _rolled(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` bytes, by doubling."""
    base = int(_BASE)
    grams, width = data.astype(np.uint64) + np.uint64(1), 1
    out, done = None, 0
    while True:
        if size & width:
            part = grams[done:]
            if out is None:
                out = part.copy()
            else:
                n = min(len(out), len(part))
                out = out[:n] * np.uint64(pow(base, width, 1 << 64)) + part[:n]
            done += width
        if 2 * width > size:
            break
        grams = grams[:-width] * np.uint64(pow(base, width, 1 << 64)) + grams[width:] if len(grams) > width else grams[:0]
        width *= 2
    return mix(out[: max(0, len(data) - size + 1)])


def anchors(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and gram hash of the anchors; rows are ``data`` cut at ``cuts``."""
    if len(data) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = _rolled(data, SEED)
    # the least of OFFSETS neighbours, by doubling; the place breaks ties
    at = np.arange(len(hashes), dtype=np.uint64)
    least, width = (hashes & ~np.uint64(0xFFFFFFFF)) | at if len(data) < 1 << 32 else _refuse(), 1
    while 2 * width <= OFFSETS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < OFFSETS:
        rest = OFFSETS - width
        least = np.minimum(least[:-rest], least[rest:])
    places = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    lengths = np.diff(cuts)
    row = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
    places = np.unique(places[row[: len(places)] == row[LENGTH - 1 : LENGTH - 1 + len(places)]])
    return row[places], places, hashes[places]


def _refuse():
    raise ValueError("a text of 4 GB or more does not fit an Arrow batch")


# --- step 1: anchors whose gram only one text has are dropped ----------------------------

_ANCHORS = "d_range int, d_blob binary"
_SHARED = "d_bucket int, d_blob binary"
_PLACES = "d_key long, d_rank long, d_places binary, d_hot binary"


def _new_texts(texts, keys: np.ndarray, ranks: np.ndarray, seen: dict[int, int]):
    """The texts of a slice that are no copies of ones seen with a smaller or equal id."""
    if len(seen) > SEEN_TEXTS:
        seen.clear()
    new = []
    for i, (key, rank) in enumerate(zip(keys.tolist(), ranks.tolist())):
        if rank < seen.get(key, _LAST + 1):
            seen[key] = rank
            new.append(i)
    if len(new) == len(keys):
        return texts.data, texts.offsets, keys, ranks
    cuts = texts.offsets
    data = np.concatenate([texts.data[cuts[i] : cuts[i + 1]] for i in new]) if new else texts.data[:0]
    return data, np.concatenate([[0], np.cumsum(np.diff(cuts)[new])]).astype(np.int64), keys[new], ranks[new]


def _anchor_blobs(ranges: int, buckets: int, hot: np.ndarray):
    """Anchors packed by range of their hashes; those of ``hot`` grams by bucket of texts, numbered after the ranges."""

    def run(batches):
        held: list = []
        owners: list = []
        seen: dict[int, int] = {}

        def flush():
            gram, text, place = (np.concatenate(x) for x in zip(*held))
            key, rank = (np.concatenate(x) for x in zip(*owners))
            held.clear()
            owners.clear()
            # texts and places ascend as gathered, and the sort is stable
            order = np.argsort(gram, kind="stable")
            gram, text, place = gram[order], text[order], place[order]
            once = first_of_runs(gram, text)  # further places of the gram in a text are found again from the first
            gram, text, place = gram[once], text[once], place[once]
            rows = []
            if len(hot):
                common = np.isin(gram, hot)
                bucket = _bucket(key[text[common]], buckets)
                for b in np.unique(bucket):
                    own, which = np.unique(text[common][bucket == b], return_inverse=True)
                    rows.append((ranges + int(b), pack(which.astype(np.uint32), place[common][bucket == b], key[own], rank[own])))
                gram, text, place = gram[~common], text[~common], place[~common]
            edges = np.searchsorted((gram >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1))
            for r in range(ranges):
                i, j = edges[r], edges[r + 1]
                if i < j:
                    texts, which = np.unique(text[i:j], return_inverse=True)
                    steps = np.diff(gram[i:j], prepend=np.uint64(0))
                    rows.append((r, pack(steps, which.astype(np.uint32), place[i:j], key[texts], rank[texts])))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary())], names=["d_range", "d_blob"])

        size = n_texts = 0
        for batch in batches:
            keys, ranks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for texts in text_slices(batch.column(2), _SLICE):
                part = slice(texts.first, texts.first + len(texts))
                data, cuts, own_keys, own_ranks = _new_texts(texts, keys[part], ranks[part], seen)
                row, place, gram = anchors(data, cuts)
                held.append((gram, (row + n_texts).astype(np.uint32), (place - cuts[row]).astype(np.uint32)))
                owners.append((own_keys, own_ranks))
                size, n_texts = size + len(row), n_texts + len(own_keys)
                if size >= BATCH_ANCHORS:
                    yield from flush()
                    size = n_texts = 0
        if size:
            yield from flush()

    return run


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _hot_places(blobs: pa.ChunkedArray) -> bytes:
    """Places of hot grams of one bucket of texts, copies united."""
    which, place, keys, ranks = zip(*[unpack(b.as_py()) for b in blobs])
    key = np.concatenate([k[w] for k, w in zip(keys, which)])
    rank = np.concatenate([r[w] for r, w in zip(ranks, which)])
    place = np.concatenate(place)
    names, text = np.unique(key, return_inverse=True)
    least = np.full(len(names), _LAST)
    np.minimum.at(least, text, rank)
    order = np.lexsort((place, text))
    text, place = text[order], place[order]
    once = first_of_runs(text, place)
    text, place = text[once], place[once]
    return pack(text.astype(np.uint32), place, np.ones(len(place), np.uint8), names, least)


def _shared_places(hot_texts: int, ranges: int, buckets: int):
    """Of one range of hashes: the places whose gram more than one text has, packed by bucket of texts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        number = key[0].as_py()
        if number >= ranges:
            return pa.table([pa.array([number - ranges], pa.int32()), pa.array([_hot_places(table.column("d_blob"))], pa.binary())], names=["d_bucket", "d_blob"])
        columns: list = [[], [], []]
        owners: list = [[], []]
        n = 0
        for blob in table.column("d_blob"):
            steps, which, place, keys, ranks = unpack(blob.as_py())
            for c, x in zip(columns, (np.cumsum(steps, dtype=np.uint64), which + np.uint32(n), place)):
                c.append(x)
            owners[0].append(keys)
            owners[1].append(ranks)
            n += len(keys)
        key, rank = (np.concatenate(c) for c in owners)
        gram, text, place = (np.concatenate(c) for c in columns)
        del columns, owners
        # copies of a text are one text, and the smallest id stands for all
        names, text_of = np.unique(key, return_inverse=True)
        least = np.full(len(names), _LAST)
        np.minimum.at(least, text_of, rank)
        text = text_of.astype(np.uint32)[text]
        order = np.lexsort((text, gram))
        gram, text, place = gram[order], text[order], place[order]
        once = first_of_runs(gram, text)
        gram, text, place = gram[once], text[once], place[once]
        starts = run_starts(gram)
        size = np.diff(np.append(starts, len(gram)))
        texts = np.repeat(size, size)
        shared = texts > 1
        text, place, hot = text[shared], place[shared], texts[shared] > hot_texts
        bucket = _bucket(names, buckets)[text]
        order = np.lexsort((place, text, bucket))
        text, place, hot, bucket = text[order], place[order], hot[order], bucket[order]
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = []
        for b in range(buckets):
            i, j = edges[b], edges[b + 1]
            if i < j:
                own, which = np.unique(text[i:j], return_inverse=True)
                rows.append((b, pack(which.astype(np.uint32), place[i:j], hot[i:j].astype(np.uint8), names[own], least[own])))
        return pa.table([pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary())], names=["d_bucket", "d_blob"])

    return run


def _places_by_text(table: pa.Table) -> pa.Table:
    """One row per text of a bucket, with its places from all ranges."""
    columns: list = [[], [], [], []]
    for blob in table.column("d_blob"):
        which, place, hot, keys, ranks = unpack(blob.as_py())
        for c, x in zip(columns, (keys[which], ranks[which], place, hot)):
            c.append(x)
    key, rank, place, hot = (np.concatenate(c) for c in columns)
    order = np.lexsort((place, key))
    key, rank, place, hot = key[order], rank[order], place[order].astype("<u4"), hot[order] > 0
    starts = run_starts(key)
    cold_blobs, hot_blobs = [], []
    for i, j in zip(starts, np.append(starts[1:], len(key))):
        p, h = place[i:j], hot[i:j]
        cold_blobs.append(p[~h].tobytes())
        hot_blobs.append(p[h].tobytes() or None)
    return pa.table(
        [pa.array(key[starts], pa.int64()), pa.array(rank[starts], pa.int64()), pa.array(cold_blobs, pa.binary()), pa.array(hot_blobs, pa.binary())],
        names=["d_key", "d_rank", "d_places", "d_hot"],
    )


# --- step 2: sorted runs, front-coded ---------------------------------------------------

_RUNS = "d_part int, d_run binary"


def _all_places(data: np.ndarray, cuts: np.ndarray, blobs: list) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of every anchor whose gram is that of a listed place."""
    row, place, gram = anchors(data, cuts)
    firsts = [np.frombuffer(b, "<u4").astype(np.int64) + cuts[r] for r, b in enumerate(blobs)]
    listed = np.zeros(len(place), dtype=bool)
    listed[np.searchsorted(place, np.concatenate(firsts))] = True
    # a gram listed for one row is not for another unless listed there too
    mark = mix(gram ^ (row.astype(np.uint64) * _BASE))
    chosen = np.isin(mark, mark[listed])
    return row[chosen], place[chosen]


def _suffixes(data: np.ndarray, cuts: np.ndarray, row: np.ndarray, place: np.ndarray):
    """The bytes after and, backwards, before each place, padded by 0; how many there are of either."""
    after = np.minimum(cuts[row + 1] - place, LENGTH)
    before = np.minimum(place - cuts[row], OFFSETS - 1)
    out = np.zeros((len(place), WIDTH), dtype=np.uint8)
    at = place[:, None] + np.arange(LENGTH)
    out[:, :LENGTH] = data[np.minimum(at, len(data) - 1)] * (np.arange(LENGTH) < after[:, None])
    at = place[:, None] - 1 - np.arange(OFFSETS - 1)
    out[:, LENGTH:] = data[np.maximum(at, 0)] * (np.arange(OFFSETS - 1) < before[:, None])
    return out, after, before


def _common(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix each row shares with the one before."""
    out = np.zeros(len(rows), dtype=np.uint8)
    if len(rows) > 1:
        differs = rows[1:] != rows[:-1]
        out[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), WIDTH)
    return out


def front_code(rows: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix lengths of sorted rows, and the bytes beyond them; rows at ``starts`` begin anew."""
    common = _common(rows)
    if starts is not None:
        common[starts] = 0
    return common, rows[np.arange(WIDTH) >= common[:, None]]


def front_decode(common: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """The rows of one run, or of several one after the other, each of which begins with a whole row."""
    n = len(common)
    out = np.zeros((n, WIDTH), dtype=np.uint8)
    own = np.arange(WIDTH) >= common[:, None]
    out[own] = tails
    for c in range(WIDTH):
        source = np.maximum.accumulate(np.where(own[:, c], np.arange(n), 0))
        out[:, c] = out[source, c]
    return out


def _sorted_runs(splitters: np.ndarray):
    """Per task, the suffixes of its texts as sorted runs, one for each partition between splitters."""

    def run(batches):
        held: list = []

        def flush():
            rows, after, before, key, rank, place = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(rows.view(f"S{WIDTH}").ravel(), kind="stable")
            rows, after, before, key, rank, place = rows[order], after[order], before[order], key[order], rank[order], place[order]
            heads = np.ascontiguousarray(rows[:, :SEED]).view(f"S{SEED}").ravel()
            edges = np.concatenate([[0], np.searchsorted(heads, splitters, "left"), [len(rows)]])
            parts = [p for p in range(len(edges) - 1) if edges[p] < edges[p + 1]]
            common, tails = front_code(rows, edges[parts])
            ends = np.concatenate([[0], np.cumsum(WIDTH - common.astype(np.int64))])
            after, before, place = after.astype(np.uint8), before.astype(np.uint8), place.astype(np.uint32)
            blobs = []
            for p in parts:
                i, j = edges[p], edges[p + 1]
                texts, one, which = np.unique(key[i:j], return_index=True, return_inverse=True)
                blobs.append(pack(common[i:j], tails[ends[i] : ends[j]], after[i:j], before[i:j], which.astype(np.uint32), place[i:j], texts, rank[i:j][one]))
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], names=["d_part", "d_run"])

        size = 0
        for keys, ranks, texts, blobs in _with_places(batches, 3):
            row, place = _all_places(texts.data, texts.offsets, blobs)
            rows, after, before = _suffixes(texts.data, texts.offsets, row, place)
            held.append((rows, after, before, keys[row], ranks[row], place - texts.offsets[row]))
            size += len(row)
            if size >= BATCH_SUFFIXES:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    return run


def _with_places(batches, column: int):
    """Slices of texts that have places in ``column``."""
    for batch in batches:
        keys, ranks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for texts in text_slices(batch.column(2), _SLICE):
            s = slice(texts.first, texts.first + len(texts))
            blobs = batch.column(column)[s].to_pylist()
            if any(blobs):
                yield keys[s], ranks[s], texts, [b or b"" for b in blobs]


# --- step 3: merge with a loser tree that knows common prefixes -----------------------------


def _mismatch(a: int, b: int) -> int:
    """Length of the common prefix of two strings, each as one number: the highest bit that differs tells it."""
    return WIDTH - ((a ^ b).bit_length() + 7 >> 3)


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """Merge sorted runs of (strings, common prefix with the one before in the run).

    Returns the run of each output in order, and its common prefix with the output
    before. Every inner node of the tree holds the loser of its last game with the
    length of its common prefix with that game's winner.
    """
    if len(runs) == 1:
        return [0] * len(runs[0][0]), list(runs[0][1])
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    numbers = [[int.from_bytes(x, "big") for x in r[0]] for r in runs] + [[]] * (leaves - len(runs))
    ends = [len(r) for r in numbers]
    commons = [r[1] for r in runs] + [[]] * (leaves - len(runs))
    at = [0] * leaves
    known = [0 if e else -1 for e in ends]  # -1: used up, loses every game
    front = [r[0] if r else 0 for r in numbers]
    loser = [0] * leaves

    def build(node: int) -> int:
        if node >= leaves:
            return node - leaves
        x, y = build(2 * node), build(2 * node + 1)
        if known[x] == known[y] >= 0:
            won, lost = (x, y) if front[x] <= front[y] else (y, x)
            known[lost] = _mismatch(front[x], front[y])
        else:
            won, lost = (x, y) if known[x] >= known[y] else (y, x)
        loser[node] = lost
        return won

    order, prefix = [], []
    winner = build(1)
    known[winner] = 0 if known[winner] >= 0 else -1
    while known[winner] >= 0:
        order.append(winner)
        prefix.append(known[winner])
        i = at[winner] + 1
        at[winner] = i
        if i < ends[winner]:
            most, front[winner] = commons[winner][i], numbers[winner][i]
        else:
            most = -1
        node = (leaves + winner) // 2
        while node:
            other = loser[node]
            rival = known[other]
            if most < rival:
                known[winner], loser[node] = most, winner
                winner, most = other, rival
            elif most == rival >= 0:
                a, b = front[winner], front[other]
                if a <= b:
                    known[other] = WIDTH - ((a ^ b).bit_length() + 7 >> 3)
                else:
                    known[winner], loser[node] = WIDTH - ((a ^ b).bit_length() + 7 >> 3), winner
                    winner = other
            node //= 2
        known[winner] = most
    return order, prefix


# --- step 4: the smallest id per string ---------------------------------------------------

_SPANS = "d_bucket int, d_blob binary"
_SPANS_OF_TEXT = "d_key long, d_rank long, starts binary, ends binary"


def _intervals(rows, common, after, before, rank, group):
    """Furthest and nearest removed offset of each suffix (-1: none).

    ``rows`` are the distinct suffixes in order with ``common`` prefixes; ``after``,
    ``before``, ``rank`` and ``group`` (its distinct suffix) are per suffix.
    """
    tail, head = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    tail[group], head[group] = after, before
    # equal suffixes from different runs stand next to each other
    new = (common < WIDTH) | np.append(True, (tail[1:] != tail[:-1]) | (head[1:] != head[:-1]))
    group = (np.cumsum(new) - 1)[group]
    rows, common, tail, head = rows[new], common[new], tail[new], head[new]
    n = len(rows)
    least = np.full(n, _LAST)
    np.minimum.at(least, group, rank)
    far, near = np.full(len(rank), -1), np.full(len(rank), -1)
    # only a gram that texts of different rank share can lead to anything
    gram = np.cumsum(common < SEED) - 1
    low, high = np.full(gram[-1] + 1, _LAST), np.zeros(gram[-1] + 1, np.int64)
    np.minimum.at(low, gram[group], rank)
    np.maximum.at(high, gram[group], rank)
    differs = low < high
    # one suffix only: all its strings are shared
    single = differs & (np.bincount(gram) == 1)
    alone = np.flatnonzero(single[gram[group]] & (least[group] < rank) & (LENGTH - after <= before))
    far[alone], near[alone] = before[alone], LENGTH - after[alone]
    active = np.flatnonzero((differs & ~single)[gram])
    place = np.full(n, -1)
    place[active] = np.arange(len(active))
    member = np.flatnonzero(place[group] >= 0)
    of = place[group[member]]
    backwards = np.zeros(len(active), np.uint64)
    for o in range(OFFSETS):
        if o:
            backwards = mix(backwards * _BASE + rows[active, LENGTH + o - 1].astype(np.uint64) + np.uint64(1))
        same_after = np.cumsum(common < LENGTH - o)[active].astype(np.uint64)
        able = (tail[active] >= LENGTH - o) & (head[active] >= o)
        if not able.any():
            continue
        string = mix(same_after * _BASE ^ backwards)[able]
        order = np.argsort(string, kind="stable")
        starts = run_starts(string[order])
        smallest = np.full(len(active), _LAST)
        found = np.minimum.reduceat(least[active][able][order], starts)
        spread = np.empty(len(string), np.int64)
        spread[order] = np.repeat(found, np.diff(np.append(starts, len(string))))
        smallest[able] = spread
        gone = smallest[of] < rank[member]
        far[member[gone]] = o
        near[member[gone & (near[member] < 0)]] = o
    return far, near


def _merge_partition(buckets: int):
    """Merges the runs of a partition and returns the removed intervals, packed by bucket of texts."""

    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_by_bucket(*_merged(table), buckets)])

    return run


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, its rank, start and end of each interval that the runs of a partition show."""
    blobs = [unpack(blob) for blob in table.column("d_run").to_pylist()]
    common, tails, after, before = (np.concatenate([b[c] for b in blobs]) for c in range(4))
    place = np.concatenate([b[5] for b in blobs]).astype(np.int64)
    key, rank = (np.concatenate([b[c][b[4]] for b in blobs]) for c in (6, 7))
    edges = np.cumsum([0, *[len(b[0]) for b in blobs]])
    del blobs
    rows = front_decode(common, tails)
    # the padding is told apart from zero bytes by the lengths
    first = first_of_runs(after, before) | (common < WIDTH)
    first[edges[:-1]] = True
    base = np.concatenate([[0], np.cumsum(first)])[edges].tolist()
    group = np.cumsum(first) - 1
    stacked, common = rows[first], common[first].tolist()
    del rows, tails
    raw = stacked.tobytes()
    order, prefix = merge_runs([([raw[k * WIDTH : (k + 1) * WIDTH] for k in range(i, j)], common[i:j]) for i, j in zip(base, base[1:])])
    del raw
    order, prefix = np.array(order), np.array(prefix)
    # a run's strings come out in the order they went in
    source = np.empty(len(order), np.int64)
    by_run = np.argsort(order, kind="stable")
    source[by_run] = np.arange(len(order))
    group = by_run[group]
    after, before = after.astype(np.int64), before.astype(np.int64)
    far, near = _intervals(stacked[source], prefix, after, before, rank, group)
    hit = far >= 0
    return key[hit], rank[hit], place[hit] - far[hit], place[hit] - near[hit] + LENGTH


def _united_by_text(key: np.ndarray, rank: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts with their ranks, and the intervals of all of them, united: text (its number), start and end."""
    order = np.lexsort((start, rank, key))
    key, rank, start, end = key[order], rank[order], start[order], end[order]
    first = first_of_runs(key, rank)
    # each text gets a stretch of its own, wider than any text, so that no two meet
    text = np.cumsum(first) - 1
    wide = int(end.max(initial=0)) + 1
    start, end = united(start + text * wide, end + text * wide)
    text = start // wide
    return key[first], rank[first], text, start - text * wide, end - text * wide


def _by_bucket(key: np.ndarray, rank: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row per bucket of texts, whatever the number of texts."""
    key, rank, text, start, end = _united_by_text(key, rank, start, end)
    bucket = _bucket(key, buckets)[text]
    order = np.argsort(bucket, kind="stable")
    text, start, end, bucket = text[order], start[order], end[order], bucket[order]
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = []
    for b in range(buckets):
        i, j = edges[b], edges[b + 1]
        if i < j:
            own, which = np.unique(text[i:j], return_inverse=True)
            rows.append((b, pack(which.astype(np.uint32), start[i:j].astype(np.uint32), end[i:j].astype(np.uint32), key[own], rank[own])))
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary())], names=["d_bucket", "d_blob"])


def _spans_by_text(table: pa.Table) -> pa.Table:
    """One row per text of a bucket, with its intervals from all partitions."""
    columns: list = [[], [], [], []]
    for blob in table.column("d_blob"):
        which, start, end, keys, ranks = unpack(blob.as_py())
        for c, x in zip(columns, (keys[which], ranks[which], start.astype(np.int64), end.astype(np.int64))):
            c.append(x)
    key, rank, text, start, end = _united_by_text(*(np.concatenate(c) for c in columns))
    edges = np.searchsorted(text, np.arange(len(key) + 1))
    start, end = start.astype("<u4"), end.astype("<u4")
    blobs = [[x[i:j].tobytes() for i, j in zip(edges[:-1], edges[1:])] for x in (start, end)]
    return pa.table([pa.array(key, pa.int64()), pa.array(rank, pa.int64()), *[pa.array(b, pa.binary()) for b in blobs]], names=["d_key", "d_rank", "starts", "ends"])


# --- hot grams -----------------------------------------------------------------------------


def _hot_strings(batches):
    """The strings at hot anchors: hash, text, rank and place."""
    for keys, ranks, texts, blobs in _with_places(batches, 4):
        data, cuts = texts.data, texts.offsets
        row, place = _all_places(data, cuts, blobs)
        hashes = _rolled(data, LENGTH)
        at = (place[:, None] - np.arange(OFFSETS)).ravel()
        of = np.repeat(row, OFFSETS)
        able = (at >= cuts[of]) & (at + LENGTH <= cuts[of + 1])
        at, of = at[able], of[able]
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes[at].view(np.int64)), pa.array(keys[of]), pa.array(ranks[of]), pa.array(at - cuts[of])], names=["d_string", "d_key", "d_rank", "d_at"]
        )


def _hot_spans(joined: DataFrame, buckets: int) -> DataFrame:
    strings = joined.mapInArrow(_hot_strings, "d_string long, d_key long, d_rank long, d_at long").distinct()
    least = strings.groupBy(F.col("d_string").alias("s")).agg(F.min("d_rank").alias("least"))
    gone = strings.join(least, F.col("d_string") == F.col("s")).where("least < d_rank").select("d_key", "d_rank", "d_at")

    def spans(batches):
        for batch in batches:
            key, rank, at = (c.to_numpy() for c in batch.columns)
            yield _by_bucket(key, rank, at, at + LENGTH, buckets)

    return gone.mapInArrow(spans, _SPANS)


# --- the whole ---------------------------------------------------------------------------------


def _cut(with_text: bool):
    """What each text loses: bytes, spans, and the hash of what is left."""

    def run(batches):
        for batch in batches:
            out: list = []
            for texts in text_slices(batch.column(1)):
                raw = texts.data.tobytes()
                for r in range(len(texts)):
                    i = texts.first + r
                    start, end = (np.frombuffer(batch.column(c)[i].as_py(), "<u4").astype(np.int64) for c in (2, 3))
                    body = raw[texts.offsets[r] : texts.offsets[r + 1]]
                    edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(body)]
                    rest = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    out.append((int((end - start).sum()), len(start), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore") if with_text else None))
            columns = [pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["r_key", "r_removed", "r_spans", "r_sha256", "r_text"])

    return run


def _pieces(total: int, each: int, most: int) -> int:
    """Pieces of ``each``; where they are many, of up to ``most`` times as much."""
    return -(-total // max(each, min(most * each, total // MANY_PIECES)))


def _splitters(sample: list[bytes], parts: int) -> np.ndarray:
    """Bounds that cut a sorted sample of suffix heads in equal parts."""
    heads = np.unique(np.frombuffer(b"".join(sample), f"S{SEED}")) if sample else np.empty(0, f"S{SEED}")
    if not len(heads) or parts < 2:
        return heads[:0]
    return np.unique(heads[np.linspace(0, len(heads), parts, endpoint=False)[1:].astype(int)])


def _heads(batches):
    """Some suffix heads of each text, to choose splitters by."""
    for keys, _, texts, blobs in _with_places(batches, 3):
        firsts = np.concatenate([np.frombuffer(b, "<u4").astype(np.int64) + texts.offsets[r] for r, b in enumerate(blobs)])[::7]
        heads = [texts.data[p : p + SEED].tobytes() for p in firsts]
        yield pa.RecordBatch.from_arrays([pa.array(heads, pa.binary())], names=["head"])


def _grams_of(batches):
    """The distinct anchor grams of each text."""
    for batch in batches:
        for texts in text_slices(batch.column(0), _SLICE):
            row, _, gram = anchors(texts.data, texts.offsets)
            order = np.lexsort((gram, row))
            once = first_of_runs(row[order], gram[order])
            yield pa.RecordBatch.from_arrays([pa.array(gram[order][once].view(np.int64))], names=["gram"])


def _hot_grams(texts: DataFrame, keys: DataFrame, n_texts: int) -> np.ndarray:
    """Grams that more than ``HOT_TEXTS`` texts seem to have, by a bounded sample of different texts."""
    if n_texts <= HOT_TEXTS:
        return np.empty(0, np.uint64)
    chosen = F.broadcast(keys.orderBy(F.xxhash64("d_key")).limit(SAMPLED_TEXTS).select(F.col("d_key").alias("s_key"), F.col("d_rank").alias("s_rank")))
    sampled = texts.join(chosen, (F.col("d_key") == F.col("s_key")) & (F.col("d_rank") == F.col("s_rank"))).select("d_text")
    least = max(3, min(SAMPLED_TEXTS, n_texts) * HOT_TEXTS // n_texts)
    # a sampled text of n bytes has some n / 18 grams, so few can reach a share of all texts
    found = sampled.mapInArrow(_grams_of, "gram long").groupBy("gram").count().where(F.col("count") >= least)
    return np.sort(np.array([r.gram for r in found.orderBy(F.desc("count"), "gram").limit(SAMPLED_HEADS).select("gram").collect()], dtype=np.int64).view(np.uint64))


def deduplicated(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """``keep`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of every document.

    ``with_text`` adds ``kept_text``, in which bytes of a split character are left
    out; ``keep`` must then have the text.
    """
    with small_batches(docs.sparkSession, BATCH_TEXTS):
        return _deduplicated(docs, keep, doc_id, text, with_text)


def _deduplicated(docs: DataFrame, keep: list[str], doc_id: str, text: str, with_text: bool) -> DataFrame:
    spark = docs.sparkSession
    scratch = Scratch(spark)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rank = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_LAST))
    own = [F.xxhash64(body).alias("d_key"), rank.alias("d_rank")]
    columns = [F.col(f"`{c}`") for c in keep]
    meta = scratch.keep(docs.select(F.struct(*columns).alias("row"), *own, F.octet_length(body).cast("long").alias("d_bytes"), F.sha2(body.cast("binary"), 256).alias("d_sha256")), "suffix-texts")
    size = meta.agg(F.sum("d_bytes")).first()[0] or 0
    texts = docs.select(*own, body.alias("d_text")).where(F.octet_length("d_text") >= LENGTH)

    ranges = max(1, _pieces(size * 2 // (OFFSETS + 1), ANCHORS_PER_TASK, MOST_ANCHORS))
    buckets = max(1, _pieces(size, BUCKET_BYTES, MOST_BYTES))
    leaders = scratch.keep(meta.groupBy("d_key").agg(F.min("d_rank").alias("d_rank"), F.max("d_bytes").alias("d_bytes")), "suffix-leaders")
    different = leaders.where(F.col("d_bytes") >= LENGTH)
    hot = _hot_grams(texts, different, different.count())
    blobs = texts.mapInArrow(_anchor_blobs(ranges, buckets, hot), _ANCHORS)
    shared = blobs.groupBy("d_range").applyInArrow(_shared_places(HOT_TEXTS, ranges, buckets), _SHARED)
    places = scratch.keep(shared.groupBy("d_bucket").applyInArrow(_places_by_text, _PLACES), "suffix-places")
    found = places.agg(F.sum(F.octet_length("d_places")).alias("cold"), F.sum(F.octet_length("d_hot")).alias("hot")).first()
    by_text = places.select("d_key", "d_rank", F.col("d_places").alias("places"), F.col("d_hot").alias("hot"))
    joined = texts.join(by_text, ["d_key", "d_rank"]).select("d_key", "d_rank", "d_text", "places", "hot")

    # splitters come from the suffixes of a bounded sample of texts; they only balance the work
    sampled = F.broadcast(by_text.orderBy(F.xxhash64("d_key")).limit(SAMPLED_TEXTS).select("d_key", "d_rank", "places", "hot"))
    parts = _pieces((found["cold"] or 0) // 4, SUFFIXES_PER_TASK, MOST_SUFFIXES)
    heads = []
    if parts > 1:
        heads = [r.head for r in texts.join(sampled, ["d_key", "d_rank"]).select("d_key", "d_rank", "d_text", "places", "hot").mapInArrow(_heads, "head binary").limit(SAMPLED_HEADS).collect()]
    runs = joined.mapInArrow(_sorted_runs(_splitters(heads, parts)), _RUNS)
    spans = runs.groupBy("d_part").applyInArrow(_merge_partition(buckets), _SPANS)
    if found["hot"]:
        spans = spans.unionByName(_hot_spans(joined, buckets))
    spans = scratch.keep(spans, "suffix-spans")
    scratch.drop(places)

    cuts = spans.groupBy("d_bucket").applyInArrow(_spans_by_text, _SPANS_OF_TEXT)
    result = texts.join(cuts, ["d_key", "d_rank"]).select("d_key", "d_text", "starts", "ends").mapInArrow(_cut(with_text), "r_key long, r_removed long, r_spans long, r_sha256 string, r_text string")
    # stored here, where batches of texts are small
    result = scratch.keep(result.dropDuplicates(["r_key"]), "suffix-cuts")
    scratch.drop(spans)
    leaders = leaders.select(F.col("d_key").alias("l_key"), F.col("d_rank").alias("l_rank"))
    whole = (F.col("d_rank") > F.col("l_rank")) & (F.col("d_bytes") >= LENGTH)

    def either(copied, cut, none):
        return F.when(whole, copied).otherwise(F.coalesce(cut, none))

    out = meta.join(leaders, F.col("d_key") == F.col("l_key")).join(result, F.col("d_key") == F.col("r_key"), "left")
    kept_text = [either(F.lit(""), F.col("r_text"), F.col("row")[text]).alias("kept_text")] if with_text else []
    return out.select(
        *[F.col("row")[c].alias(c) for c in keep],
        F.col("d_bytes").alias("n_bytes"),
        either(F.col("d_bytes"), F.col("r_removed"), F.lit(0)).cast("long").alias("n_removed"),
        either(F.lit(1), F.col("r_spans"), F.lit(0)).cast("long").alias("n_spans"),
        either(F.lit(hashlib.sha256(b"").hexdigest()), F.col("r_sha256"), F.col("d_sha256")).alias("kept_sha256"),
        *kept_text,
    )
