"""Toxicity, vector codes and hard negatives."""

import hashlib
import math
import os
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import connect, difference  # noqa: E402

from orefold.llm import hard_negatives, toxicity, vector_codes  # noqa: E402
from orefold.llm.fuzzy import KINDS, Automaton, Term  # noqa: E402
from orefold.llm.queries import QUERIES  # noqa: E402
from orefold.llm.rtree import NO_ID, Best, Queries, Tree, packed_order, search  # noqa: E402
from orefold.llm.words import text_slices  # noqa: E402


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_hard_negatives"])
def test_whole_table_against_sql(spark, medium, name):
    run, sql = QUERIES[name]
    assert difference(run(spark, medium), connect(medium), sql) is None


# --- vectors of odd kinds

BAD = [None, [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0]]


def odd_vectors(spark, seed=3):
    rng = random.Random(seed)
    rows = [(i, i % 4 if i % 9 else None, [rng.choice([-1.5, -0.25, 0.0, 0.1, 0.3, 2.0]) for _ in range(16)]) for i in range(300)]
    rows += [(1000 + i, 1, v) for i, v in enumerate(BAD)]
    rows += [(300, 1, [0.1] * 5), (400, 2, []), (500, 2, [9e9] + [0.0] * 15), (None, 3, [0.3] * 16)]
    rows += rows[:60] + [(200, 3, [0.3] * 16)] * 40  # repeated rows, and one vector with many copies
    return rows, spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "'x' as code", "1 as score", "2 as h_id", "3 as v_row")


def usable(vector, scale, largest, width):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    whole = [max(-largest, min(largest, math.floor(scale * float(np.float32(x))))) for x in vector]
    return whole + [0] * (width - len(whole))


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, label, usable(v, 4096, vector_codes.LARGEST, 16)) for i, label, v in rows]
    kept = [r for r in kept if r[2] is not None]
    d = 16 // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[r[2][p * d : p * d + d] for r in first] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, _, v in kept:
                part = v[p * d : p * d + d]
                groups.setdefault(nearest(p, part)[1], []).append(part)
            for k, members in groups.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    out, per_label = [], {}
    for i, label, v in kept:
        found = [nearest(p, v[p * d : p * d + d]) for p in range(parts)]
        error = sum(f[0] for f in found)
        per_label[label] = per_label.get(label, 0) + error
        out.append((i, label, "".join(f"{f[1]:02x}" for f in found), error))
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, c, e, per_label[label], sha) for i, label, c, e in out), key=str)


def test_codes_of_odd_vectors(spark):
    rows, frame = odd_vectors(spark)
    got = vector_codes.compressed(frame, [F.col("vec_id"), F.col("code").alias("v_code_")], F.col("embedding"), F.col("vec_id"), F.col("label"))
    assert sorted((tuple(r[c] for c in ("vec_id", "v_code", "v_error", "v_label_error", "v_books")) for r in got.collect()), key=str) == plain_codes(rows)


def test_codes_of_few_and_no_rows(spark):
    frame = spark.createDataFrame([(5, 1, [1.0, 2.0, 3.0]), (4, None, [0.0, 0.0, 0.0])], "vec_id long, label int, embedding array<double>")
    args = ([F.col("vec_id")], F.col("embedding"), F.col("vec_id"), F.col("label"))
    assert {(r.vec_id, r.v_code, r.v_error, r.v_label_error) for r in vector_codes.compressed(frame, *args).collect()} == {(5, "01010100" + "00" * 4, 0, 0), (4, "00" * 8, 0, 0)}
    assert vector_codes.compressed(frame.where("false"), *args).count() == 0
    assert vector_codes.compressed(frame.selectExpr("vec_id", "label", "cast(null as array<double>) as embedding"), *args).count() == 0


@pytest.mark.parametrize("entries", [1, 16, 100])
def test_masks_give_the_nearest_entry(entries):
    rng = np.random.default_rng(entries)
    book = vector_codes.Codebook(rng.integers(-30, 30, (entries, 6)))
    x = rng.integers(-40, 40, (3000, 6))
    distance = ((x[:, None] - book.entries[None]) ** 2).sum(axis=2)
    code, least = book.nearest(x)
    assert (code == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()
    mask = book.candidates(x, np.full(len(x), 9))
    inside = (np.abs(x[:, None] - book.entries[None]) <= 9).all(axis=2)
    assert (np.unpackbits(mask.astype("<u8").view(np.uint8), axis=1, count=entries, bitorder="little") == inside).all()


# --- hard negatives


def plain_negatives(rows, anchor, k=5, low=80, high=100):
    kept = [(i, label, usable(v, 256, hard_negatives.LARGEST, 16)) for i, label, v in rows if label is not None]
    kept = [(NO_ID if i is None else i, label, v) for i, label, v in kept if v is not None]
    out = []
    for n, (i, label, v) in enumerate(kept):
        if i == NO_ID or not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for m, (j, other, w) in enumerate(kept) if m != n)
        for negative_p, j, _ in [s for s in scored if s[2] == label][:k]:
            p = -negative_p
            fits = [s for s in scored if s[2] != label and low * p <= -100 * s[0] <= high * p][:k]
            out += [(i, None if j == NO_ID else j, rank, None if s[1] == NO_ID else s[1], p, -s[0]) for rank, s in enumerate(fits, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("tile, block", [(8192, 4096), (50, 3)])
def test_negatives_of_odd_vectors(spark, monkeypatch, tile, block):
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    rows, frame = odd_vectors(spark)
    got = hard_negatives.mined(frame, F.col("vec_id"), F.col("label"), F.col("embedding"), F.col("vec_id") % 20 == 0)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_negatives(rows, lambda i: i % 20 == 0)


def test_no_anchors_and_no_rows(spark):
    _, frame = odd_vectors(spark)
    args = (F.col("vec_id"), F.col("label"), F.col("embedding"))
    assert hard_negatives.mined(frame, *args, F.lit(False)).count() == 0
    assert hard_negatives.mined(frame.where("false"), *args, F.lit(True)).count() == 0


def test_tree_search_prunes_and_finds_all():
    rng = np.random.default_rng(5)
    centres = rng.integers(-200, 200, (40, 8))
    vectors = np.repeat(centres, 100, axis=0) + rng.integers(-5, 6, (4000, 8))
    labels, ids = rng.integers(0, 3, 4000), rng.permutation(4000)
    order, starts = packed_order(labels, vectors)
    assert sorted(order) == list(range(4000)) and (np.diff(np.append(starts, 4000)) <= 128).all()
    tree = Tree(ids[order], labels[order], vectors[order], starts)
    anchors = np.arange(0, 4000, 100)
    queries = Queries(vectors[anchors], labels[anchors], np.full(len(anchors), -1), np.full((len(anchors), 1), -(10**9)), np.full((len(anchors), 1), 10**5), False)
    best = queries.best(7)
    search(tree, queries, best)
    for n, a in enumerate(anchors):
        score = vectors @ vectors[a]
        wanted = sorted((-s, i) for s, i, other in zip(score, ids, labels) if other != labels[a] and s <= 10**5)[:7]
        mine = best.query == n
        assert list(zip(-best.score[mine], best.id[mine])) == wanted


def test_best_keeps_ties_by_id():
    best = Best(1, 2)
    for score, who in (([5, 5], [9, 7]), ([5], [8]), ([4], [1])):
        best.offer(np.zeros(len(score), dtype=np.int64), np.array(score), np.array(who))
    assert list(best.id) == [7, 8] and best.kth_id[0] == 8


# --- toxicity


def distance(word, term):
    d = list(range(len(word) + 1))
    for i, a in enumerate(term.text, 1):
        last, d[0] = d[0], i
        for j, b in enumerate(word, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (a != b))
    return min(d) if term.stem else d[-1]


def test_automaton_against_edit_distances():
    rng = random.Random(2)
    terms = [Term("loser", False), Term("idiot", False), Term("lowei", True), Term("chón", True), Term("worthless", False), Term("scum", False), Term("lostrand", True), Term("loseriest", False)]
    words = []
    for term in terms * 150:
        word = list(term.text)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word))
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "ó", "s", "es"])
            word = word or ["q"]
        words.append("".join(word) + "".join(rng.choices("aeß", k=rng.randint(0, 3) if term.stem else 0)))
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    sizes = np.array([len(w.encode()) for w in words])
    starts = np.cumsum(sizes + 1) - sizes - 1
    got = Automaton(terms).matches(data, starts, starts + sizes)
    for word, found in zip(words, got):
        near = [(distance(word, t), t.stem, -len(t.text), i) for i, t in enumerate(terms) if distance(word, t) <= t.edits]
        assert found == (min(near)[3] * KINDS + min(near)[0] if near else -1), word
    assert (Automaton([]).matches(data, starts, starts + sizes) == -1).all()


def one_hit(text):
    (slice_,) = text_slices(pa.array([text]))
    return toxicity.hits(slice_, Automaton([Term("idiot", False)]))


def test_context_tells_quotation_from_abuse():
    plain, quoted, told, address = (one_hit(t) for t in ("he was an idiot there", 'he was an "idiot" there', "he was called an idiot there", "you are an idiot there"))
    assert quoted.abuse[0] < told.abuse[0] < plain.abuse[0] < address.abuse[0]
    assert quoted.quoted[0] > told.quoted[0] > plain.quoted[0] == 0
    assert one_hit("idiot idiot").abuse[0] > 2 * plain.abuse[0] and list(one_hit("an id1ot").key) == [1] and not len(one_hit("").key)
    far = one_hit('"' + "thing " * 30 + "idiot " + "thing " * 30 + '"')
    assert far.quoted[0] == 0


def toxic_corpus(n=900):
    rng = random.Random(8)
    common = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        words = rng.choices(common, k=rng.randint(20, 120))
        toxic = i % 8 == 0
        for _ in range(rng.randint(2, 4) if toxic else 0):
            term = rng.choice(["nastyword", "vilething", "grumpf" + rng.choice(common)])
            words[rng.randrange(len(words))] = term
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_learnt_lexicon_catches_misspellings_and_spares_quotations(spark):
    rows = toxic_corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert set(model.terms) == {Term("nastyword", False), Term("vilething", False), Term("grumpf", True)}
    got = {r.doc_id: r.x_score for r in toxicity.scored(docs, model, [F.col("doc_id")], F.col("text")).collect()}
    assert all((got[i] >= 0.5) == bool(t) for i, _, t in rows)
    cases = ["you nastywerd and vilethlng", "you n4styword vilething grumpfhead", 'he said "nastyword" means it', "abc def", "", None]
    odd = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string").selectExpr("*", "'z' as x_score", "2.0 as score")
    score = {r.doc_id: r.x_score for r in toxicity.scored(odd, model, [F.col("doc_id")], F.col("text")).collect()}
    assert min(score[0], score[1]) >= 0.5 > score[2] > score[3] == pytest.approx(score[4]) == pytest.approx(score[5])


def test_near_copies_make_no_terms(spark):
    rows = toxic_corpus(400)
    copied = " ".join(f"own{i}word" for i in range(60))
    rows += [(1000 + i, copied + f" end{i}", 1) for i in range(40)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert not [t for t in model.terms if t.text.startswith("own")]


def test_toxicity_without_classes(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(i, 0) for i in range(8)] + [(3, 0), (None, 1)], "doc_id long, toxic int")
    for docs in (odd_documents, no_documents):
        for known in (labels, labels.where("false"), labels.withColumn("toxic", F.lit(1))):
            model = toxicity.fit(docs, known)
            got = toxicity.scored(docs, model, [F.col("doc_id"), F.col("score")], F.col("text")).collect()
            assert len(got) == docs.count() and all(0 <= r.x_score <= 1 and r.score == 2 for r in got)
    assert not odd_documents.where("doc_id is null").select(toxicity.held_out(F.col("doc_id")).alias("h")).first().h


def test_one_long_text(spark):
    """A text of more than a slice: the hit at its end counts as one at its start."""
    model = toxicity.Model(0.5, [Term("vilething", False)], np.array([3.0, 1.0, 0.5]), np.array([-2.0, 1.0, 0, 0, 0]))
    filler = "some words of no harm " * 300_000
    docs = spark.createDataFrame([(1, filler + "vilething"), (2, "vilething " + filler), (3, filler)], "doc_id long, text string")
    got = {r.doc_id: r.x_score for r in toxicity.scored(docs, model, [F.col("doc_id")], F.col("text")).collect()}
    assert got[1] == pytest.approx(got[2]) and got[1] > got[3]


def test_toxicity_on_held_out_rows(spark, small):
    folder = small.replace("0.001", "0.1")
    if not os.path.isdir(folder):
        pytest.skip("no larger tables")
    got = QUERIES["op11_toxicity"][0](spark, folder)
    known = spark.read.parquet(f"{folder}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = got.where("held_out").join(known, "doc_id").select("toxic", "predicted").collect()
    caught = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert sum(caught) >= 0.92 * len(caught)  # some labelled documents hold no lexical sign at all
    assert sum(clean) <= 0.01 * len(clean) and clean
