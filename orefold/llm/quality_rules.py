"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Each rule rejects a document whose value lies above a cutoff. Cutoffs are chosen per
stratum (language) from labelled documents: going from the loosest to the tightest
one, a cutoff stays admissible while the exact binomial (Clopper-Pearson) bound on
the share of good documents it rejects is at most ``risk / number of rules``. Testing
nested cutoffs in that fixed order needs no correction among them; over rules and
strata the error level is divided (Bonferroni). So with probability ``1 - error`` no
stratum loses more than ``risk`` of its good documents to all rules together. Among
the admissible cutoffs the one with the most rejected bad less rejected good
documents is taken, the loosest of equals; a stratum with too few labels for any
bound has no cutoff and keeps its documents.

Defined cases: a null text has no words; a null stratum is a stratum of its own; a
label given twice for a document counts as good if any of them is good; rows may
repeat; rows with equal ids are judged one by one; an empty table gives no rows; texts of
any length are counted whole, each by one task; of cutoffs with equal gain the loosest is
taken; columns to keep stand in a struct of their own, so their names clash with nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.llm.scratch import Scratch

RISK = 0.05
ERROR = 0.05
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
_SPACE = r"[\x20\x09-\x0D]+"
_WHITE = " \t\n\x0b\f\r"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_EXTRA = ("__q_lines", "__q_capitals", "__q_marks")

# Cutoffs of each rule, loosest first.
CUTOFFS = {
    "symbols": (0.3, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04),
    "capitals": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "marks": (1.5, 1.0, 0.75, 0.5, 0.3),
    "repeats": (0.45, 0.4, 0.3, 0.25, 0.2),
    "lines": (0.9, 0.7, 0.5, 0.4, 0.3),
    "long_words": (40.0, 30.0, 20.0, 15.0, 12.0),
}


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def measures(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the counts of each text; see ``COUNTS``.

    All work is inside the row: windows of three words are hashed, and only a text in
    which a hash repeats has its windows sorted to find which words they cover. Each
    step is a column of its own, since a lambda would compute it again per element.
    """
    empty = F.array().cast("array<bigint>")
    df = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__q_text"))
    body = F.col("__q_text")
    df = df.withColumn("__q_words", F.array_remove(F.split(body, _SPACE), ""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.translate(x, _WHITE, "") != "")
    df = df.withColumn("__q_line", lines)
    words, line = F.col("__q_words"), F.col("__q_line")
    size = F.length(body)
    df = df.select(
        *[F.col(f"`{c}`") for c in keep],
        words,
        F.size(words).cast("long").alias("n_words"),
        _without(body, _WHITE).cast("long").alias("word_chars"),
        (size - _without(body, SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"),
        F.size(line).cast("long").alias("__q_lines"),
        (size - _without(body, _CAPITALS)).cast("long").alias("__q_capitals"),
        (size - _without(body, "!")).cast("long").alias("__q_marks"),
    )
    rest = [F.col(f"`{c}`") for c in keep] + [F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", *_EXTRA)]
    window = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(empty)
    df = df.select(*rest, window.alias("__q_windows"))
    windows = F.col("__q_windows")
    placed = F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
    )
    df = df.select(*rest, placed.alias("__q_sorted"))
    order = F.col("__q_sorted")
    twice = F.transform(
        order,
        lambda x, j: F.when(
            (F.get(order, j - 1)["h"] == x["h"]).eqNullSafe(True) | (F.get(order, j + 1)["h"] == x["h"]).eqNullSafe(True),
            x["i"],
        ),
    )
    df = df.select(*rest, F.array_sort(F.filter(twice, lambda x: x.isNotNull())).alias("__q_places"))
    places = F.col("__q_places")
    fresh = F.transform(places, lambda p, j: F.when(j == 0, F.lit(3)).otherwise(F.least(F.lit(3), p - F.get(places, j - 1))))
    covered = F.aggregate(fresh, F.lit(0).cast("long"), lambda a, x: a + x)
    # the optimizer moves no condition below a column that is not deterministic; moved down, a
    # condition on this one would repeat its whole computation for every window of the text
    nothing = F.when(F.monotonically_increasing_id() < 0, 1).otherwise(0)
    return df.select(*rest, (F.coalesce(covered, F.lit(0)) + nothing).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def rule_values() -> dict[str, Column]:
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / chars,
        "capitals": F.col("__q_capitals") / chars,
        "marks": F.col("__q_marks") / words,
        "repeats": F.col("n_repeat_words") / words,
        "lines": F.col("n_dup_lines") / F.greatest(F.col("__q_lines"), F.lit(1)),
        "long_words": F.col("word_chars") / words,
    }


def most_allowed(n: Column, rate: Column, log_level: Column) -> Column:
    """Largest k with P(Binomial(n, rate) <= k) <= level, by summing exact terms in logarithms; -1 if none.

    Rejecting at most k of n good documents then bounds the true share by ``rate``
    (one-sided Clopper-Pearson at that level).
    """
    start = F.struct(
        (n * F.log1p(-rate)).cast("double").alias("term"),
        F.lit(float("-inf")).alias("total"),
        F.lit(-1).cast("long").alias("best"),
    )

    def step(a: Column, i: Column) -> Column:
        high = F.greatest(a["total"], a["term"])
        total = high + F.log(F.exp(a["total"] - high) + F.exp(a["term"] - high))
        return F.struct(
            (a["term"] + F.log((n - i) / (i + 1)) + F.log(rate / (1 - rate))).cast("double").alias("term"),
            total.alias("total"),
            F.when(total <= log_level, i).otherwise(a["best"]).cast("long").alias("best"),
        )

    # k stays below n * rate, so no further term is needed
    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.floor(n * rate).cast("long")), start, step, lambda a: a["best"])


def cutoffs(measured: DataFrame, labels: DataFrame, doc_id: str = "doc_id", stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per stratum with labels: ``__q_stratum`` and a cutoff (or null) per rule."""
    values = rule_values()
    marked = labels.select(F.col(doc_id).alias("__q_id"), "quality").where("quality in (0, 1)").groupBy("__q_id").agg(F.max("quality").alias("__q_good"))
    known = measured.where(~base_failed()).join(marked, F.col(f"`{doc_id}`") == F.col("__q_id"))
    counted = [F.count_if(F.col("__q_good") == 1).alias("n_good")]
    for rule, grid in CUTOFFS.items():
        for j, cut in enumerate(grid):
            over = values[rule] > cut
            counted.append(F.count_if(over & (F.col("__q_good") == 1)).alias(f"{rule}_good_{j}"))
            counted.append(F.count_if(over & (F.col("__q_good") == 0)).alias(f"{rule}_bad_{j}"))
    by_stratum = known.groupBy(F.col(f"`{stratum}`").alias("__q_stratum")).agg(*counted)
    level = by_stratum.agg((F.log(F.lit(error / len(CUTOFFS))) - F.log(F.count(F.lit(1)))).alias("log_level"))
    rate = F.lit(risk / len(CUTOFFS))
    # one row on the right
    bounded = by_stratum.join(F.broadcast(level)).withColumn("allowed", most_allowed(F.col("n_good"), rate, F.col("log_level")))
    chosen = []
    for rule, grid in CUTOFFS.items():
        tried = F.array(*[
            F.struct(
                (F.col(f"{rule}_bad_{j}") - F.col(f"{rule}_good_{j}")).alias("gain"),
                F.lit(-j).alias("looser"),
                F.lit(cut).alias("cut"),
                F.col(f"{rule}_good_{j}").alias("lost"),
            )
            for j, cut in enumerate(grid)
        ])
        fit = F.filter(tried, lambda x: (x["lost"] <= F.col("allowed")) & (x["gain"] > 0))
        chosen.append(F.array_max(fit)["cut"].alias(f"__cut_{rule}"))
    return bounded.select("__q_stratum", *chosen)


def judged(measured: DataFrame, chosen: DataFrame, stratum: str = "lang") -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``."""
    broken = F.lit(False)
    for rule, value in rule_values().items():
        broken = broken | F.coalesce(value > F.col(f"__cut_{rule}"), F.lit(False))
    return (
        measured.join(chosen, F.col(f"`{stratum}`").eqNullSafe(F.col("__q_stratum")), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~broken)
    )


def quality_rules(docs: DataFrame, labels: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """``row`` (the columns ``keep``), the counts, ``base_failed`` and ``kept`` of every document.

    The counts are stored once, for the cutoffs and the verdict alike.
    """
    scratch = Scratch(docs.sparkSession)
    wanted = {"row": F.struct(*[F.col(f"`{c}`") for c in keep]), "__q_doc": F.col(f"`{doc_id}`"), "__q_of": F.col(f"`{stratum}`"), "__q_body": F.col(f"`{text}`")}
    source = docs.select(*[c.alias(name) for name, c in wanted.items()])
    measured = scratch.keep(measures(source, ["row", "__q_doc", "__q_of"], "__q_body"), "measured")
    known = labels.select(F.col(doc_id).alias("__q_doc"), "quality")
    chosen = scratch.keep(cutoffs(measured, known, "__q_doc", "__q_of"), "cutoffs")
    return judged(measured, chosen, "__q_of").select("row", *COUNTS, "base_failed", "kept")


def good_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """The documents that no rule rejects, with their own columns.

    Neither stored nor shuffled in between are whole texts: the counts are stored for
    the cutoffs, and taken again as the documents pass.
    """
    scratch = Scratch(docs.sparkSession)
    wanted = {"row": F.struct(*[F.col(f"`{c}`") for c in docs.columns]), "__q_doc": F.col(f"`{doc_id}`"), "__q_of": F.col(f"`{stratum}`"), "__q_body": F.col(f"`{text}`")}
    source = docs.select(*[c.alias(name) for name, c in wanted.items()])
    known = labels.select(F.col(doc_id).alias("__q_doc"), "quality")
    measured = measures(source, ["__q_doc", "__q_of"], "__q_body")
    chosen = scratch.keep(cutoffs(scratch.keep(measured, "measured"), known, "__q_doc", "__q_of"), "cutoffs")
    kept = judged(measures(source, ["row", "__q_of"], "__q_body"), chosen, "__q_of").where("kept")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def smallest_stratum(risk: float = RISK, error: float = ERROR, strata: int = 1) -> int:
    """Good labels a stratum needs before any cutoff can be admissible."""
    share = risk / len(CUTOFFS)
    return math.ceil(math.log(error / len(CUTOFFS) / strata) / math.log1p(-share))
