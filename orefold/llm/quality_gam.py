"""Quality classifier: a generalised additive model with pairwise interactions.

Features are counts and shares of the whole text, computed over a slice of texts at
once. Each is cut into bins at quantiles of the training rows. Training boosts
shallow trees in turn, one feature at a time, and adds them up to one look-up table
per feature; then pairs of features with the largest remaining gain get tables of
their own, boosted the same way. Scoring adds table entries by bin.

The model is fitted on at most ``SAMPLE`` labelled rows that are not held out, taken
in hash order of their id; everything is scored. Ids, labels, language and source
never reach a feature.

Defined cases: null and empty texts have all features 0 and are scored; without
training rows of both classes the score is their share, 0.5 without any; a document
labelled twice counts once, as good if any label says so; a null id is not held out;
rows may repeat; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.arrow import append
from orefold.llm.words import SPACED, Texts, grams, list_array

SAMPLE = 20_000
BINS = 32
ROUNDS = 120
PAIR_ROUNDS = 40
PAIRS = 6
RATE = 0.15
RIDGE = 2.0

FEATURES = (
    "log_words", "word_bytes", "capitals", "digits", "symbols", "marks", "stops", "beyond_ascii", "line_words", "repeated_neighbours",
    "distinct_words", "distinct_triples", "top_word", "distinct_lines", "short_words", "sentence_ends",
)


def _class(characters: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=np.int64)
    out[[*characters]] = 1
    return out


_CLASSES = {
    "capitals": _class(bytes(range(65, 91))),
    "digits": _class(b"0123456789"),
    "symbols": _class(b"#*$%&|<>=~^\\{}[]@"),
    "marks": _class(b"!?"),
    "stops": _class(b".,;:"),
    "beyond_ascii": _class(bytes(range(0x80, 0x100))),
}
_NEWLINE = np.ones(256, dtype=bool)
_NEWLINE[0x0A] = False


def _per_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return (sums[rows[1:]] - sums[rows[:-1]]).astype(np.float64)


def _distinct(values: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the most frequent one's count, per row."""
    if not len(values):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    first = np.concatenate([[True], (v[1:] != v[:-1]) | (r[1:] != r[:-1])])
    at = np.flatnonzero(first)
    top = np.zeros(n)
    np.maximum.at(top, r[at], np.diff(np.append(at, len(v))))
    return np.bincount(r[at], minlength=n).astype(np.float64), top


def features(texts: Texts) -> np.ndarray:
    """A row of ``FEATURES`` for each text."""
    n, cuts, data = len(texts), texts.offsets, texts.data
    words = texts.words(SPACED)
    counts = np.diff(words.rows).astype(np.float64)
    row = np.repeat(np.arange(n), counts.astype(np.int64))
    size = np.maximum(np.diff(cuts).astype(np.float64), 1)
    some = np.maximum(counts, 1)
    lengths = words.ends - words.starts
    out = {"log_words": np.log1p(counts), "word_bytes": _per_row(lengths, words.rows) / some}
    for name, table in _CLASSES.items():
        out[name] = _per_row(table[data], cuts) / size
    lines = texts.words(_NEWLINE)
    line_row = np.repeat(np.arange(n), np.diff(lines.rows))
    n_lines = np.maximum(np.diff(lines.rows).astype(np.float64), 1)
    out["line_words"] = np.log1p(counts / n_lines)
    beside = np.zeros(len(row), dtype=np.int64)
    if len(row):
        beside[1:] = (words.hashes[1:] == words.hashes[:-1]) & (row[1:] == row[:-1])
    out["repeated_neighbours"] = _per_row(beside, words.rows) / some
    distinct, top = _distinct(words.hashes, row, n)
    out["distinct_words"], out["top_word"] = distinct / np.sqrt(some), top / some
    triples = grams(words.hashes, 3)
    at = np.flatnonzero(row[: len(triples)] == row[2 : 2 + len(triples)])
    out["distinct_triples"] = _distinct(triples[at], row[at], n)[0] / np.maximum(counts - 2, 1)
    out["distinct_lines"] = _distinct(lines.hashes, line_row, n)[0] / n_lines
    out["short_words"] = _per_row(lengths <= 2, words.rows) / some
    out["sentence_ends"] = _per_row(np.isin(data[words.ends - 1], np.frombuffer(b".!?", np.uint8)), words.rows) / some
    return np.stack([out[f] for f in FEATURES], axis=1)


@dataclass
class Model:
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if self.edges:
            b = self.bins(x)
            for f, table in enumerate(self.tables):
                out += table[b[:, f]]
            for (f, g), table in zip(self.pairs, self.pair_tables):
                out += table[b[:, f], b[:, g]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _best_cut(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int]:
    g, h = np.cumsum(gradient), np.cumsum(weight)
    if len(g) < 2:
        return 0.0, 0
    gain = g[:-1] ** 2 / (h[:-1] + RIDGE) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + RIDGE) - g[-1] ** 2 / (h[-1] + RIDGE)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A tree of up to four leaves over the bins of one feature."""
    out = np.empty(len(gradient))
    cuts = [0, len(gradient)]
    for _ in range(3):
        found = [(*_best_cut(gradient[i:j], weight[i:j]), i) for i, j in zip(cuts, cuts[1:])]
        gain, at, i = max(found)
        if gain <= 1e-9:
            break
        cuts = sorted([*cuts, i + at])
    for i, j in zip(cuts, cuts[1:]):
        out[i:j] = gradient[i:j].sum() / (weight[i:j].sum() + RIDGE)
    return out


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The tree with one cut on either feature, and its gain."""
    g, h = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)

    def four(x):
        a = x[:-1, :-1]
        return a, x[:-1, -1:] - a, x[-1:, :-1] - a, x[-1, -1] - x[:-1, -1:] - x[-1:, :-1] + a

    gain = sum(p**2 / (q + RIDGE) for p, q in zip(four(g), four(h)))
    i, j = np.unravel_index(np.argmax(gain), gain.shape)
    out = np.empty(gradient.shape)
    for s in (np.s_[: i + 1, : j + 1], np.s_[: i + 1, j + 1 :], np.s_[i + 1 :, : j + 1], np.s_[i + 1 :, j + 1 :]):
        out[s] = gradient[s].sum() / (weight[s].sum() + RIDGE)
    return float(gain[i, j] - g[-1, -1] ** 2 / (h[-1, -1] + RIDGE)), out


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting on features ``x`` and classes ``y``."""
    if not len(y):
        return Model()
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(base=float(np.log(share / (1 - share))))
    if y.min() == y.max():
        return model
    model.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in sizes]
    margin = np.full(len(y), model.base)

    def residual():
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, size in enumerate(sizes):
            g, h = residual()
            step = RATE * _tree(np.bincount(bins[:, f], g, size), np.bincount(bins[:, f], h, size))
            model.tables[f] += step
            margin += step[bins[:, f]]

    def cells(f, g):
        return bins[:, f] * sizes[g] + bins[:, g]

    def square(f, g, values):
        return np.bincount(cells(f, g), values, sizes[f] * sizes[g]).reshape(sizes[f], sizes[g])

    g, h = residual()
    able = [f for f in range(len(sizes)) if sizes[f] > 1]
    gains = [(_quadrants(square(a, b, g), square(a, b, h))[0], a, b) for i, a in enumerate(able) for b in able[i + 1 :]]
    model.pairs = [(a, b) for _, a, b in sorted(gains, reverse=True)[:PAIRS]]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            g, h = residual()
            step = RATE * _quadrants(square(a, b, g), square(a, b, h))[1]
            model.pair_tables[k] += step
            margin += step[bins[:, a], bins[:, b]]
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model of ``label`` from at most ``sample`` labelled rows that are not held out."""
    known = labels.where(~held_out(F.col(doc_id)) & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("g_id")).agg(F.max(label).alias("g_label"))
    # bounded by ``sample``, a few hundred kilobytes
    chosen = F.broadcast(known.orderBy(F.xxhash64("g_id"), "g_id").limit(sample))
    rows = docs.join(chosen, F.col(f"`{doc_id}`") == F.col("g_id")).select("g_id", "g_label", F.col(f"`{text}`").alias("g_text"))

    def work():
        return lambda texts, _: [list_array(features(texts).ravel(), np.full(len(texts), len(FEATURES)), pa.float64())]

    added = T.StructType([T.StructField("g_features", T.ArrayType(T.DoubleType()))])
    found = append(rows, [F.col("g_id"), F.col("g_label")], F.col("g_text"), added, work)
    # a document whose id is used twice must not pass the bound either
    table = found.orderBy(F.xxhash64("g_id"), "g_id", "g_features").limit(sample).toArrow()
    x = np.array(table["g_features"].to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
    return train(x, table["g_label"].to_numpy().astype(np.float64))


def scored(docs: DataFrame, model: Model, keep: list[Column], text: Column) -> DataFrame:
    """``keep`` and ``g_score``, the probability of class 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        return lambda texts, _: [pa.array(shared.value.score(features(texts)))]

    return append(docs, keep, text, T.StructType([T.StructField("g_score", T.DoubleType())]), work)
