"""Toxicity: a learnt lexicon, its misspellings, and the words around each hit.

**Lexicon.** Among labelled documents every word and every word beginning of four to
eight letters is counted once per document and class. Kept are those that mark toxic
documents beyond what chance explains for as many candidates (a Chernoff bound on the
binomial tail, times the number of candidates, below one) and stand in toxic ones for
the most part. Of nested candidates the strongest stays: ``idiot`` rather than
``idio...``, and one stem rather than all its words. Near copies among the labelled
documents count once (equal least hashes of five-word shingles), so a copied text does
not make terms of its words.

**Misspellings** are caught by Levenshtein automata intersected with the lexicon trie
(``fuzzy``). Every term has a weight per number of edits: log-odds, drawn to half the
exact weight where few labelled documents have that misspelling.

**Context.** In a window of ``SPAN`` words on either side, quotation marks around the
hit and words of reporting (``said``, ``the word``) lower its share of abuse, words
that address somebody and further hits raise it. What a hit loses counts as quoted.

A document's four numbers (abuse over its terms, its densest share, its worst term,
quoted weight) go into a logistic score. Its weights are fitted to the same labelled
documents, each scored with term weights that leave out its own label.

Learnt from at most ``SAMPLE`` labelled rows that are not held out, in hash order of
their id; every document is scored. Ids, labels, language and source enter no score.

Defined cases: null and empty texts have no hits and are scored; without labelled rows
of both classes the score is their share, 0.5 without any; a document labelled twice
counts once, as toxic if any label says so; a null id is not held out; a text longer
than a slice is a slice of its own; rows may repeat; an empty table gives no rows;
extra columns pass through ``keep``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.arrow import append
from orefold.llm.fuzzy import KINDS, Automaton, Term
from orefold.llm.scratch import Scratch
from orefold.llm.shipping import ship
from orefold.llm.words import ALNUM, Texts, Words, grams, hash_spans, list_array, mix, text_slices

SAMPLE = 20_000
# Candidates that reach the driver, and terms of the lexicon at most.
CANDIDATES = 5_000
TERMS = 500
STEMS = range(4, 9)
SPAN = 8
RIDGE = 1.0
_SIGNS = np.array([1, 1, 1, -1])

# Words that report what others say, and words that address somebody.
REPORTING = (
    "said says saying called calls quote quoted quotes wrote writes word words term terms insult insults slur meaning means "
    "sagte sagt nannte wort zitat begriff disait appelé citation terme dijo dice llamó palabra cita término"
).split()
ADDRESSING = "you your yours youre dich dein deine euch toi vous votre vosotros usted ustedes".split()
# Shares of a hit left by quotation marks around it and by words of reporting, and raised by others.
QUOTED, REPORTED, ADDRESSED, TOGETHER = 0.3, 0.6, 1.3, 0.2


def _hashes(words: list[str]) -> np.ndarray:
    out = []
    for w in words:
        data = np.frombuffer(w.encode(), np.uint8)
        out.append(hash_spans(data, np.array([0]), np.array([len(data)])))
    return np.concatenate(out)


_REPORTING, _ADDRESSING = _hashes(REPORTING), _hashes(ADDRESSING)


def _marks(data: np.ndarray) -> np.ndarray:
    """Places of quotation marks: the ASCII one, and typographic ones of several bytes by their last byte."""
    plain = np.flatnonzero(data == 0x22)
    if len(data) < 3:
        return plain
    curved = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80) & (data[2:] >= 0x9C) & (data[2:] <= 0x9E)) + 2
    angled = np.flatnonzero((data[:-1] == 0xC2) & ((data[1:] == 0xAB) | (data[1:] == 0xBB))) + 1
    return np.sort(np.concatenate([plain, curved, angled]))


def _row_of(rows: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))


@dataclass
class Hits:
    """Per text and key (``term * KINDS + edits``): summed abuse and summed quotation of its hits; and words per text."""

    row: np.ndarray
    key: np.ndarray
    abuse: np.ndarray
    quoted: np.ndarray
    words: np.ndarray


def hits(texts: Texts, automaton: Automaton) -> Hits:
    low = texts.lower()
    words = low.words(ALNUM)
    n_words = np.diff(words.rows)
    found = automaton.matches(low.data, words.starts, words.ends)
    at = np.flatnonzero(found >= 0)
    if not len(at):
        none = np.empty(0, dtype=np.int64)
        return Hits(none, none, none.astype(np.float64), none.astype(np.float64), n_words)
    row = np.searchsorted(words.rows, at, "right") - 1
    first, last = np.maximum(at - SPAN, words.rows[row]), np.minimum(at + SPAN + 1, words.rows[row + 1])

    def inside(places: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.searchsorted(places, j) - np.searchsorted(places, i)

    marks = _marks(low.data)
    # marks before the first word of the text or line still belong to the window
    before = inside(marks, np.where(first > words.rows[row], words.starts[first], texts.offsets[row]), words.starts[at])
    after = inside(marks, words.ends[at], np.where(last < words.rows[row + 1], words.ends[last - 1], texts.offsets[row + 1]))
    share = np.where((before > 0) & (after > 0), QUOTED, 1.0)
    share *= np.where(inside(np.flatnonzero(np.isin(words.hashes, _REPORTING)), first, last) > 0, REPORTED, 1.0)
    quoted = 1 - share
    share *= np.where(inside(np.flatnonzero(np.isin(words.hashes, _ADDRESSING)), first, last) > 0, ADDRESSED, 1.0)
    share *= 1 + TOGETHER * np.minimum(inside(at, first, last) - 1, 3)
    keys = KINDS * max(1, len(automaton.terms))
    pair, place = np.unique(row * keys + found[at], return_inverse=True)
    return Hits(pair // keys, pair % keys, np.bincount(place, share), np.bincount(place, quoted), n_words)


def features(found: Hits, weight: np.ndarray) -> np.ndarray:
    """Four numbers per text; ``weight`` is that of each of the hits' rows."""
    n = len(found.words)
    abuse = weight * np.log1p(found.abuse)
    worst = np.zeros(n)
    np.maximum.at(worst, found.row, weight * np.minimum(found.abuse, 1))
    dense = np.bincount(found.row, weight * found.abuse, n) / (found.words + 20)
    columns = [np.bincount(found.row, abuse, n), worst, np.log1p(np.maximum(100 * dense, 0)), np.bincount(found.row, weight * np.log1p(found.quoted), n)]
    return np.stack(columns, axis=1)


@dataclass
class Model:
    share: float = 0.5
    terms: list[Term] = field(default_factory=list)
    weights: np.ndarray | None = None
    coefficients: np.ndarray | None = None

    def score(self, texts: Texts, automaton: Automaton) -> np.ndarray:
        if self.coefficients is None:
            return np.full(len(texts), self.share)
        found = hits(texts, automaton)
        x = features(found, self.weights[found.key])
        return 1 / (1 + np.exp(-(self.coefficients[0] + x @ self.coefficients[1:])))


def _log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: np.ndarray, n_clean: np.ndarray) -> np.ndarray:
    return np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))


def _weights(key: np.ndarray, toxic: np.ndarray, clean: np.ndarray, exact: np.ndarray) -> np.ndarray:
    """Log-odds of a key; of misspellings drawn to half the exact term's by four documents' worth."""
    edits = key % KINDS
    own = _log_odds(toxic, clean, exact[:, 2], exact[:, 3])
    whole = _log_odds(exact[:, 0], exact[:, 1], exact[:, 2], exact[:, 3])
    n = toxic + clean
    return np.clip(np.where(edits == 0, own, (n * own + 4 * 0.5 * whole) / (n + 4)), -2, 7)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights with an intercept; abuse may only raise the score and quotation only lower it."""
    used = np.arange(x.shape[1])
    while True:
        w = _newton(x[:, used], y)
        right = w[1:] * _SIGNS[used] >= 0
        if right.all():
            break
        used = used[right]
    out = np.zeros(x.shape[1] + 1)
    out[0], out[used + 1] = w[0], w[1:]
    return out


def _newton(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression that prefers small weights; the intercept is free."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([np.ones(len(x)), x / scale])
    w, ridge = np.zeros(z.shape[1]), np.diag([1e-3, *[RIDGE] * x.shape[1]])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return np.concatenate([w[:1], w[1:] / scale])


def train(terms: list[Term], found: Hits, y: np.ndarray) -> Model:
    """Term weights and the logistic score from the hits of labelled texts."""
    n_toxic, n_clean = y.sum(), (1 - y).sum()
    model = Model(share=float((n_toxic + 0.5) / (len(y) + 1)) if len(y) else 0.5, terms=terms)
    if not n_toxic or not n_clean:
        return model
    keys = KINDS * max(1, len(terms))
    label = y[found.row]
    toxic, clean = np.bincount(found.key, label, keys), np.bincount(found.key, 1 - label, keys)
    all_keys = np.arange(keys)

    def weights(key, own_label=None):
        out_t, out_c = (0, 0) if own_label is None else (own_label, 1 - own_label)
        exact = key - key % KINDS
        # the text itself may or may not have the exact term; only its own key is taken out
        same = (key == exact).astype(float)
        counts = np.stack([toxic[exact] - out_t * same, clean[exact] - out_c * same, n_toxic - out_t + 0 * same, n_clean - out_c + 0 * same], axis=1)
        return _weights(key, toxic[key] - out_t, clean[key] - out_c, counts)

    model.weights = weights(all_keys)
    model.coefficients = _logistic(features(found, weights(found.key, label)), y)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _signatures(texts: Texts) -> list[np.ndarray]:
    """Two least hashes of each text's five-word shingles, or of its words if fewer."""
    words = texts.lower().words(ALNUM)
    out = [np.zeros(len(texts), dtype=np.uint64) for _ in range(2)]
    row = _row_of(words.rows)
    five = grams(words.hashes, 5)
    full = np.flatnonzero(row[: len(five)] == row[4 : 4 + len(five)])
    few = np.flatnonzero(np.diff(words.rows)[row] < 5)
    values, owner = np.concatenate([five[full], words.hashes[few]]), np.concatenate([row[full], row[few]])
    order = np.argsort(owner, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.empty(0, dtype=np.int64)
    for i, salt in enumerate((np.uint64(0), np.uint64(0x5851F42D4C957F2D))):
        if len(starts):
            out[i][owner[starts]] = np.minimum.reduceat(mix(values ^ salt), starts)
    return out


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, size: int) -> DataFrame:
    """Labelled texts (``t_label``, ``t_text``), at most ``size``, stored; of near copies the one with the smallest id."""
    known = labels.where(~held_out(F.col(doc_id)) & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("t_id")).agg(F.max(label).cast("int").alias("t_label"))
    chosen = F.broadcast(known.orderBy(F.xxhash64("t_id"), "t_id").limit(size))  # bounded by ``size``
    rows = docs.join(chosen, F.col(f"`{doc_id}`") == F.col("t_id")).select("t_id", "t_label", F.col(f"`{text}`").cast("string").alias("t_text"))

    def work():
        return lambda texts, _: [pa.array(s.view(np.int64)) for s in _signatures(texts)]

    added = T.StructType([T.StructField(c, T.LongType()) for c in ("t_a", "t_b")])
    found = append(rows, [F.col("t_id"), F.col("t_label"), F.col("t_text")], F.col("t_text"), added, work)
    stored = Scratch(docs.sparkSession).keep(found.withColumn("t_row", F.monotonically_increasing_id()), "labelled")
    first = stored.groupBy("t_a").agg(F.min(F.struct("t_id", "t_row", "t_b")).alias("f"))
    first = first.groupBy("f.t_b").agg(F.min(F.struct("f.t_id", "f.t_row")).alias("g")).orderBy("g").limit(size).select(F.col("g.t_row").alias("k_row"))
    return stored.join(F.broadcast(first), F.col("t_row") == F.col("k_row"), "left_semi").select("t_row", "t_label", "t_text")


def _counted(texts: Texts, label: np.ndarray) -> tuple[list[np.ndarray], pa.Array]:
    """Distinct words and word beginnings of a slice: length in letters (0: whole word), toxic and all texts, and the text of each."""
    low = texts.lower()
    words: Words = low.words(ALNUM)
    row = _row_of(words.rows)
    starts_char = np.concatenate([[0], np.cumsum((low.data & 0xC0) != 0x80)])
    letters = np.flatnonzero((low.data & 0xC0) != 0x80)
    length = starts_char[words.ends] - starts_char[words.starts]
    spans = [(0, np.arange(len(row)), words.ends)]
    for n in STEMS:
        longer = np.flatnonzero(length > n)
        spans.append((n, longer, letters[starts_char[words.starts[longer]] + n]))
    hashed, owner, size, start, end = [], [], [], [], []
    for n, which, stop in spans:
        h = words.hashes if n == 0 else hash_spans(low.data, words.starts[which], stop)
        hashed.append(mix(h + np.uint64(n)))
        owner.append(row[which])
        size.append(np.full(len(which), n))
        start.append(words.starts[which])
        end.append(stop)
    hashed, owner, size, start, end = (np.concatenate(c) for c in (hashed, owner, size, start, end))
    order = np.lexsort((owner, hashed))
    hashed, owner, size, start, end = (c[order] for c in (hashed, owner, size, start, end))
    if not len(order):
        return [size, size, size], pa.array([], type=pa.string())
    other = np.append(True, hashed[1:] != hashed[:-1])
    once = other | np.append(True, owner[1:] != owner[:-1])  # a term once per text
    at = np.flatnonzero(other)
    toxic, texts_ = np.add.reduceat(once * label[owner], at), np.add.reduceat(once.astype(np.int64), at)
    lengths = end[at] - start[at]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    take = np.repeat(start[at] - offsets[:-1], lengths) + np.arange(offsets[-1])
    body = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(low.data[take]))
    return [size[at], toxic, texts_], body.cast(pa.string())


def lexicon(labelled: DataFrame, most: int = TERMS) -> list[Term]:
    """Words and stems that mark toxic texts beyond chance."""
    ship(labelled.sparkSession)
    schema = "l_text string, l_size long, l_toxic long, l_all long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy().astype(np.int64)
            for texts in text_slices(batch.column(1)):
                numbers, body = _counted(texts, label[texts.first : texts.first + len(texts)])
                yield pa.RecordBatch.from_arrays([body, *[pa.array(c.astype(np.int64)) for c in numbers]], names=["l_text", "l_size", "l_toxic", "l_all"])

    n, toxic = labelled.agg(F.count("*"), F.sum("t_label")).first()
    if not toxic or toxic == n:
        return []
    share = toxic / n
    counted = labelled.select("t_label", "t_text").mapInArrow(run, schema).groupBy("l_text", "l_size").agg(F.sum("l_toxic").alias("l_toxic"), F.sum("l_all").alias("l_all")).where("l_all >= 3")
    counted = Scratch(labelled.sparkSession).keep(counted, "terms")
    part = F.col("l_toxic") / F.col("l_all")
    rest = F.when(part < 1, (1 - part) * F.log((1 - part) / F.lit(1 - share))).otherwise(0.0)
    strength = F.col("l_all") * (part * F.log(part / F.lit(share)) + rest)
    tried = max(counted.count(), 1)
    strong = counted.where((part >= 0.5) & (part > share)).withColumn("l_strength", strength).where(F.col("l_strength") > float(np.log(tried)))
    best = strong.orderBy(F.desc("l_strength"), (F.col("l_size") == 0).desc(), F.desc(F.length("l_text")), "l_text").limit(CANDIDATES).collect()
    return nested_out([Term(r.l_text, r.l_size > 0) for r in best], most)


def nested_out(candidates: list[Term], most: int = TERMS) -> list[Term]:
    """Of candidates that begin alike, one a stem or part of the other, the first stays."""
    words: set[str] = set()
    stems: set[str] = set()
    begun: set[str] = set()
    out = []
    for term in candidates:
        covered = any(term.text[:i] in stems for i in range(1, len(term.text) + 1))
        if covered or (term.stem and term.text in begun) or (not term.stem and term.text in words):
            continue
        out.append(term)
        (stems if term.stem else words).add(term.text)
        begun.update(term.text[:i] for i in range(1, len(term.text) + 1))
        if len(out) == most:
            break
    return out


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", size: int = SAMPLE) -> Model:
    """Lexicon, weights and score from at most ``size`` labelled rows that are not held out."""
    labelled = sample(docs, labels, doc_id, text, label, size)
    terms = lexicon(labelled)

    def work():
        automaton = Automaton(terms)

        def one(texts: Texts, _) -> list[pa.Array]:
            found = hits(texts, automaton)
            n = np.bincount(found.row, minlength=len(texts))
            return [pa.array(found.words), list_array(found.key, n, pa.int64()), list_array(found.abuse, n, pa.float64()), list_array(found.quoted, n, pa.float64())]

        return one

    long, double = T.LongType(), T.DoubleType()
    added = T.StructType([T.StructField("f_words", long), *[T.StructField(c, T.ArrayType(t)) for c, t in (("f_key", long), ("f_abuse", double), ("f_quoted", double))]])
    # bounded by ``size`` rows with at most a number per term and kind each
    table = append(labelled, [F.col("t_label")], F.col("t_text"), added, work).toArrow()
    lists = {c: table[c].combine_chunks() for c in ("f_key", "f_abuse", "f_quoted")}
    row = np.repeat(np.arange(len(table)), np.diff(lists["f_key"].offsets.to_numpy())) if len(table) else np.empty(0, dtype=np.int64)
    found = Hits(row, *[lists[c].flatten().to_numpy() for c in lists], table["f_words"].to_numpy())
    return train(terms, found, table["t_label"].to_numpy().astype(np.float64))


def scored(docs: DataFrame, model: Model, keep: list[Column], text: Column) -> DataFrame:
    """``keep`` and ``x_score``, the probability that the text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        automaton = Automaton(shared.value.terms)
        return lambda texts, _: [pa.array(shared.value.score(texts, automaton))]

    return append(docs, keep, text, T.StructType([T.StructField("x_score", T.DoubleType())]), work)
