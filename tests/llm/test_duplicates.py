"""Near copies, repeated passages and repeated substrings, against brute force."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import linked, repeated_words, shingle_set, without_repeats

from orefold.llm import ngram_join, passages, suffix_dedup
from orefold.llm.components import components
from orefold.llm.packing import pack, unpack
from orefold.llm.queries import QUERIES
from orefold.llm.words import text_slices


def prose(rng, n):
    return [rng.choice("stone river paper lamp green window under about seven train") + str(rng.randrange(60)) for _ in range(n)]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(10**6))
    return words


@pytest.fixture(scope="module")
def copies(spark):
    """Groups of near copies of different closeness, exact copies, and passages shared by other texts."""
    rng = random.Random(7)
    texts = []
    for size in (60, 120, 300):
        base = prose(rng, size)
        texts += [" ".join(base)] * 3 + [" ".join(edited(rng, base, e)) for e in (1, 1, 2, 2, 3, 4, 5, 6, 8, 10, 15)]
        texts += [" ".join(base[:-2]), " ".join(base[3:]), " ".join(prose(rng, 40) + base[:55] + prose(rng, 40))]
    texts += [" ".join(prose(rng, 150)) for _ in range(20)]
    rng.shuffle(texts)
    return spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def check_join(docs, k, percent):
    rows = docs.select("doc_id", "text").collect()
    sets = [shingle_set(r.text, k) for r in rows]
    label = linked(sets, percent)
    least = {}
    for r, c in zip(rows, label):
        if r.doc_id is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    want = sorted(((r.doc_id, len(s), least.get(c) if s else r.doc_id) for r, s, c in zip(rows, sets, label)), key=str)
    found = ngram_join.near_duplicates(docs, ["doc_id"], k=k, percent=percent).collect()
    assert sorted(((r.doc_id, r.j_size, r.j_component) for r in found), key=str) == want


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80), (3, 50)])
def test_ngram_join(copies, k, percent):
    check_join(copies, k, percent)


def test_ngram_join_without_broadcast(spark, copies, hot):
    check_join(copies, 4, 85)


def test_ngram_join_edges(odd_documents, no_documents):
    check_join(odd_documents, 4, 85)
    assert ngram_join.near_duplicates(no_documents, ["doc_id"]).count() == 0


def test_ngram_join_whole_table(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    check_join(docs, 4, 85)
    got = QUERIES["op1_ngram_join"][0](spark, medium)
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == docs.count()


def test_one_per_group(copies, odd_documents):
    rows = copies.orderBy("doc_id").collect()
    label = linked([shingle_set(r.text, 5) for r in rows], 80)
    kept = ngram_join.one_per_group(copies)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({rows[c].doc_id for c in label})
    assert kept.columns == copies.columns
    odd = ngram_join.one_per_group(odd_documents)
    assert odd.columns == odd_documents.columns
    # two rows are repeated, texts without words all stay
    assert odd.count() == odd_documents.count() - 2


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, j) for j in range(1001, 1100)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(80)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in parent if x not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- substrings ------------------------------------------------------------------------------


def check_substrings(docs, **options):
    rows = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *x) for r, x in zip(rows, without_repeats([(r.doc_id, r.text) for r in rows]))), key=str)
    found = suffix_dedup.deduplicated(docs, ["doc_id"], **options).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found), key=str) == want


@pytest.mark.parametrize("limits", [{}, {"HOT_TEXTS": 2}, {"SUFFIXES_PER_TASK": 200, "BATCH_SUFFIXES": 300, "BATCH_ANCHORS": 500, "ANCHORS_PER_TASK": 400, "_SLICE": 3000}])
def test_substrings(copies, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    check_substrings(copies)


@pytest.mark.parametrize("limits, buckets", [({}, 1), ({"BUCKET_BYTES": 10_000}, 12)])
def test_substrings_of_a_partition_take_a_row_per_bucket(copies, monkeypatch, limits, buckets):
    """Not a row per text and partition, of which there are more than in proportion to the texts."""
    rows, parts = {}, []
    keep, splitters = suffix_dedup.Scratch.keep, suffix_dedup._splitters

    def counted(self, df, label):
        stored = keep(self, df, label)
        rows[label] = stored.count()
        return stored

    monkeypatch.setattr(suffix_dedup.Scratch, "keep", counted)
    monkeypatch.setattr(suffix_dedup, "_splitters", lambda sample, n: parts.append(n) or splitters(sample, n))
    for name, value in {"SUFFIXES_PER_TASK": 200, **limits}.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    check_substrings(copies)
    assert 0 < rows["suffix-spans"] <= max(1, parts[0]) * buckets


def test_intervals_of_texts_are_united_apart():
    key, rank = np.array([5, 5, -3, 5, -3, 7]), np.array([1, 1, 2, 1, 2, 9])
    start, end = np.array([60, 0, 0, 50, 100, 0]), np.array([120, 50, 100, 70, 110, 4])
    table = pa.Table.from_batches([suffix_dedup._by_bucket(key[s], rank[s], start[s], end[s], 3) for s in (slice(0, 3), slice(3, 6), slice(0, 0))])
    got = []
    for bucket in set(table.column("d_bucket").to_pylist()):
        one = suffix_dedup._spans_by_text(table.filter(pa.compute.equal(table.column("d_bucket"), bucket)))
        got += [(r["d_key"], r["d_rank"], *[np.frombuffer(r[c], "<u4").tolist() for c in ("starts", "ends")]) for r in one.to_pylist()]
    assert sorted(got) == [(-3, 2, [0], [110]), (5, 1, [0], [120]), (7, 9, [0], [4])]


def test_runs_of_a_partition_cost_little_each(monkeypatch):
    """The more texts, the more runs in each of more partitions: what is done for every run grows with their square."""
    rng = random.Random(3)
    shared = [" ".join(prose(rng, 12)) for _ in range(6)]
    texts = pa.array([f"{' '.join(prose(rng, 5))} {rng.choice(shared)} {' '.join(prose(rng, 5))}\0" for _ in range(60)])
    every = [row.astype("<u4").tobytes() for part in text_slices(texts) for at in [suffix_dedup.anchors(part.data, part.offsets)] for row in [at[1][at[0] == r] - part.offsets[r] for r in range(len(part))]]
    batches = [pa.RecordBatch.from_arrays([pa.array([7 * i]), pa.array([i]), texts[i : i + 1], pa.array([every[i]])], names=["k", "r", "t", "p"]) for i in range(60)]
    decode, calls = suffix_dedup.front_decode, []
    monkeypatch.setattr(suffix_dedup, "front_decode", lambda *coded: calls.append(len(coded[0])) or decode(*coded))

    def merged(batch):
        monkeypatch.setattr(suffix_dedup, "BATCH_SUFFIXES", batch)
        runs = pa.Table.from_batches(list(suffix_dedup._sorted_runs(np.empty(0, f"S{suffix_dedup.SEED}"))(iter(batches))))
        return len(runs), sorted(zip(*[c.tolist() for c in suffix_dedup._merged(runs)]))

    one, many = merged(10**6), merged(1)
    assert one[0] == 1 and many[0] == 60 and one[1] == many[1] and one[1]
    assert calls == [sum(len(e) // 4 for e in every)] * 2


def test_pieces_of_a_batch_grow_slower_than_the_texts():
    """Every batch is cut into all ranges, and every range and partition into all buckets."""
    anchors, each = 48_000_000, suffix_dedup.ANCHORS_PER_TASK
    few, many = (suffix_dedup._pieces(n, each, suffix_dedup.MOST_ANCHORS) for n in (anchors, 12 * anchors))
    assert few < many < 6 * few and 12 * anchors / many <= suffix_dedup.MOST_ANCHORS * each
    assert [suffix_dedup._pieces(n, 10, 4) for n in (0, 1, 10, 11)] == [0, 1, 1, 2]


def test_substrings_edges(spark, odd_documents, no_documents):
    check_substrings(odd_documents)
    assert suffix_dedup.deduplicated(no_documents, ["doc_id"]).count() == 0
    zero, long = "a\0" * 40, "xyz" * 30000
    rows = [(1, "ab" * 300), (2, "ba" * 100), (3, "é" * 60), (4, "x" + "é" * 40), (5, zero), (6, "\0" + zero), (7, "q" * 49), (8, "q" * 49), (9, "q" * 50), (None, "q" * 51)]
    rows += [(None, "ab" * 300), (10, long), (11, "z" + long[:200] + "w"), (11, "ab" * 300), (5, "é" * 60 + "tail")]
    check_substrings(spark.createDataFrame(rows, "doc_id long, text string"))


def test_substrings_text(spark):
    shared = " ".join(f"shared{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"one {shared} end"), (2, f"two {shared} tail"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in suffix_dedup.deduplicated(docs, ["doc_id", "text"], with_text=True).collect()}
    assert got == {1: f"one {shared} end", 2: "twotail", 3: ""} or got[2] in ("twotail", "two tail", "two" + "tail")


def test_substrings_whole_table(spark, small):
    check_substrings(spark.read.parquet(f"{small}/documents.parquet"))
    assert QUERIES["op10_suffix_array_dedup"][0](spark, small).where("n_removed > 0").count() > 0


strings = st.lists(st.binary(min_size=0, max_size=6).map(lambda x: x.ljust(suffix_dedup.WIDTH, b"\0")), max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(strings.filter(len), min_size=1, max_size=7))
def test_merge_keeps_order_and_prefixes(runs):
    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))

    runs = [sorted(r) for r in runs]
    order, prefix = suffix_dedup.merge_runs([(r, [0, *[common(a, b) for a, b in zip(r, r[1:])]]) for r in runs])
    at = [0] * len(runs)
    out = []
    for r in order:
        out.append(runs[r][at[r]])
        at[r] += 1
    assert out == sorted(x for r in runs for x in r)
    assert prefix[1:] == [common(a, b) for a, b in zip(out, out[1:])]


@settings(max_examples=30, deadline=None)
@given(strings)
def test_front_coding_round_trip(rows):
    rows = np.frombuffer(b"".join(sorted(rows)), np.uint8).reshape(-1, suffix_dedup.WIDTH)
    common, tails = suffix_dedup.front_code(rows)
    assert (suffix_dedup.front_decode(common, tails) == rows).all()
    assert all((a == b).all() for a, b in zip(unpack(pack(common, tails)), (common, tails)))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("abc ", max_size=120), max_size=5))
def test_anchors_are_the_same_in_equal_strings(texts):
    """Every LENGTH bytes of a text have an anchor, at the same place in equal strings."""
    for part in text_slices(pa.array(texts, pa.string())):
        row, place, gram = suffix_dedup.anchors(part.data, part.offsets)
        held = {}
        for r in range(len(part)):
            at = place[row == r]
            for i in range(part.offsets[r], part.offsets[r + 1] - suffix_dedup.LENGTH + 1):
                inside = at[(at >= i) & (at < i + suffix_dedup.OFFSETS)] - i
                string = part.data[i : i + suffix_dedup.LENGTH].tobytes()
                assert len(inside)
                grams = {part.data[i + o : i + o + suffix_dedup.SEED].tobytes() for o in inside}
                assert held.setdefault(string, grams) & grams


# --- passages --------------------------------------------------------------------------------


def words_of(spans):
    return {i for s in filter(None, spans.split(",")) for i in range(*map(int, s.split(":")))}


def test_passages(copies):
    rows = copies.collect()
    want = dict(zip((r.doc_id for r in rows), repeated_words([(r.doc_id, r.text) for r in rows])))
    found = passages.repeated_passages(copies, ["doc_id", "text"]).collect()
    assert len(found) == len(rows)
    exact = hit = 0
    for r in found:
        got = words_of(r.spans)
        assert len(got) == r.n_repeated and r.n_removed <= r.n_repeated <= r.n_words
        assert (r.other_id is not None) == (r.n_repeated > 0)
        exact, hit = exact + len(want[r.doc_id]), hit + len(want[r.doc_id] & got)
    assert hit >= 0.95 * exact
    # texts of their own are left alone
    assert sum(r.n_repeated == 0 for r in found) >= 20


def test_passages_are_similar(copies):
    """What is reported has a partner of at least the stated similarity."""
    rows = {r.doc_id: r.text for r in copies.collect()}
    for r in passages.repeated_passages(copies, ["doc_id"]).where("n_removed > 0").collect():
        mine = shingle_set(rows[r.doc_id], 5)
        assert any(len(mine & shingle_set(t, 5)) >= 30 for i, t in rows.items() if i < r.doc_id)


def test_passages_edges(spark, odd_documents, no_documents):
    assert passages.repeated_passages(no_documents, ["doc_id"]).count() == 0
    found = passages.repeated_passages(odd_documents, ["doc_id", "text", "n_words", "size"][:2]).collect()
    assert len(found) == odd_documents.count()
    assert {r.n_repeated for r in found if r.text is None or len(r.text) < 100} == {0}
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(1, text), (2, text), (None, text), (3, "a b " + text + " c"), (4, text[:-4])]
    got = {r.doc_id: (r.n_repeated, r.n_removed, r.other_id) for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    assert got[1][:2] == (50, 0) and got[2] == (50, 50, 1) and got[None] == (50, 50, 1)
    assert got[3] == (50, 50, 1) and got[4][0] == 0


@pytest.mark.parametrize("size, edits", [(60, 0), (120, 0), (160, 2)])
def test_passages_of_frequent_shingles(spark, size, edits):
    """Two texts share a passage; smaller texts and texts between them hold each of its shingles in other surroundings."""
    rng = random.Random(size)

    def filler(n):
        return [f"f{rng.randrange(10**9)}" for _ in range(n)]

    def scattered(passage):
        return " ".join(w for k in rng.sample(range(len(passage) - 4), len(passage) - 4) for w in filler(60) + passage[k : k + 5])

    rows, pairs = [], []
    for case in range(6):
        passage = filler(size)
        near = list(passage)
        for e in range(edits):
            near[(e + 1) * size // (edits + 1)] = "edit"
        at = 100 * case
        rows += [(at + i, scattered(passage)) for i in (1, 2, 3, 11, 12, 13, 21)]
        rows += [(at + 10, " ".join(filler(70) + passage + filler(70))), (at + 20, " ".join(filler(70) + near + filler(70)))]
        pairs.append((at + 10, at + 20))
    found = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    alike = set(range(70, 70 + size))
    for a, b in pairs:
        assert len(words_of(found[a].spans) & alike) >= 0.9 * size and len(words_of(found[b].spans) & alike) >= 0.9 * size
        assert (found[a].n_removed, found[a].other_id) == (0, b) and found[b].n_removed == found[b].n_repeated and found[b].other_id == a
    for r in found.values():
        # brute force: the scattered texts have no passage with any other
        assert r.n_repeated == 0 or r.doc_id % 100 in (10, 20)


def test_windows_of_a_text_that_repeats_a_value():
    """The neighbour of a text's second window is the text before, not the text itself."""
    value = np.array([7, 7, 7, 7], np.uint64)
    of, at = np.array([0, 1, 2, 2], np.uint32), np.array([50, 50, 50, 200], np.uint32)
    room = np.full(4, 45, np.uint32)
    beside = np.arange(4 * (2 * passages._SIDE + 1), dtype=np.uint64).astype(np.uint8)
    blob = pack(np.diff(value, prepend=np.uint64(0)), of, at, room, room, np.zeros(4, np.uint8), np.array([1, 2, 3]), np.array([1, 2, 3]), beside)
    got = passages._join_windows(pa.table({"p_blob": [blob]})).to_pylist()
    assert {(r["m_key"], r["at"], r["h_key"]) for r in got} == {(2, 50, 1), (3, 50, 1), (3, 50, 2), (3, 200, 1), (3, 200, 2)}


def test_passages_whole_table(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip((r.doc_id for r in docs), repeated_words([(r.doc_id, r.text) for r in docs])))
    got = {r.doc_id: words_of(r.spans) for r in QUERIES["op9_substring_dedup"][0](spark, medium).collect()}
    assert got.keys() == want.keys()
    assert sum(len(got[i] & w) for i, w in want.items()) >= 0.97 * sum(map(len, want.values()))
    assert sum(bool(w) and not got[i] for i, w in want.items()) <= 0.01 * sum(map(bool, want.values()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), max_size=25), max_size=4), st.integers(2, 8))
def test_compact_windows(rows, length):
    """Every window of the tree with room, and no other."""
    from orefold.llm.words import mix

    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    values = mix(np.array([x for r in rows for x in r], dtype=np.uint64) + np.uint64(5))
    got = sorted(zip(*(x.tolist() for x in passages.compact_windows(row, values, length))))
    want = []
    order = [(int(v) >> 32, i) for i, v in enumerate(values)]
    for c in range(len(row)):
        low = high = c
        while low > 0 and row[low - 1] == row[c] and order[low - 1] > order[c]:
            low -= 1
        while high + 1 < len(row) and row[high + 1] == row[c] and order[high + 1] > order[c]:
            high += 1
        if high - low + 1 >= length:
            want.append((c, low, high))
    assert got == sorted(want)
