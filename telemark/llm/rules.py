"""Quality rules: base rules on exact text statistics, then a learned decision list.

``statistics`` turns texts into columns with built-in functions only.  ``learn`` runs sequential
covering over the statistics of labelled documents: each rule is a conjunction of thresholds, grown
by information gain on one part of the examples and pruned on the other, and the examples it covers
leave the pool before the next rule is grown.  ``verdict`` writes the list as one ordered conditional
expression, so that scoring is a plain projection over any number of documents.

Nulls and edge cases: a null text counts as empty (no words, ``base_failed``); null ids are kept;
repeated rows are judged one by one; with no labelled rows the list is empty and only the base rules
decide.  Other columns pass through ``passed`` unchanged; in ``judge`` those with the name of a result give way to it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from telemark.llm.shared import SPACE_CLASS, unused, words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: At most so many labelled documents are learned from, those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
MIN_PRECISION = 0.95
MIN_COVER = 8
MAX_RULES = 24
MAX_TERMS = 4
THRESHOLDS = 48

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATES = (
    "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "distinct_rate", "upper_rate", "digit_rate", "mark_rate", "pipe_rate",
)
PREFIX = "_q_"


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows that occur twice or more, from the windows' hashes in text order."""
    keyed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    pairs = F.zip_with(
        keyed, F.slice(keyed, 2, F.greatest(F.size(windows), F.lit(1))),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
    )
    starts = F.sort_array(F.array_distinct(F.flatten(pairs)))
    covered = F.zip_with(
        starts, F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))),
        lambda p, q: F.least(F.lit(WINDOW), F.coalesce(q - p, F.lit(WINDOW))),
    )
    return F.aggregate(covered, F.lit(0), lambda total, n: total + n)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts and, under names with a prefix, the rates that rules are learned on.

    Everything of a text is computed inside its row: no shuffle, and memory in proportion to one text.
    Windows are compared by a 64-bit hash.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    p = PREFIX
    out = docs.withColumns({f"{p}text": value, f"{p}words": words(F.col(text))})
    n = F.size(f"{p}words")
    out = out.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.concat_ws("", f"{p}words")).cast("long"),
            "n_symbols": (F.length(f"{p}text") - F.length(F.regexp_replace(f"{p}text", "[#*$%&|<>]", ""))).cast("long"),
            f"{p}lines": F.filter(F.split(f"{p}text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            f"{p}windows": F.when(
                n >= WINDOW,
                F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(F.get(f"{p}words", i + k) for k in range(WINDOW)))),
            ).otherwise(F.array().cast("array<bigint>")),
            f"{p}distinct": F.size(F.array_distinct(f"{p}words")),
        }
    )
    distinct_windows = F.size(F.array_distinct(f"{p}windows"))
    out = out.withColumns(
        {
            "n_dup_lines": (F.size(f"{p}lines") - F.size(F.array_distinct(f"{p}lines"))).cast("long"),
            "n_repeat_words": F.when(distinct_windows == F.size(f"{p}windows"), F.lit(0))
            .otherwise(_repeat_words(F.col(f"{p}windows")))
            .cast("long"),
        }
    )
    per_word = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    per_char = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")

    def share(pattern: str) -> Column:
        return (F.length(f"{p}text") - F.length(F.regexp_replace(f"{p}text", pattern, ""))) / per_char

    out = out.withColumns(
        {
            f"{p}word_length": F.col("word_chars") / per_word,
            f"{p}symbol_rate": F.col("n_symbols") / per_word,
            f"{p}dup_line_rate": F.col("n_dup_lines") / F.greatest(F.size(f"{p}lines"), F.lit(1)).cast("double"),
            f"{p}repeat_rate": F.col("n_repeat_words") / per_word,
            f"{p}distinct_rate": F.col(f"{p}distinct") / per_word,
            f"{p}upper_rate": share(r"\p{Lu}+"),
            f"{p}digit_rate": share(r"[0-9]+"),
            f"{p}mark_rate": share(r"[!?]+"),
            f"{p}pipe_rate": share(r"[|]+"),
        }
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))
    results = [*COUNTS, *(p + r for r in RATES)]
    # the array of one struct keeps later filters above: pushed below, they would work out every statistic again
    row = F.array(F.struct(*results, failed.alias("base_failed")))
    return out.select(*docs.columns, F.inline(row))


@dataclass(frozen=True)
class Term:
    """``statistic <= threshold`` or ``statistic > threshold``."""

    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        at = F.lit(self.threshold)
        return F.col(PREFIX + self.statistic) > at if self.above else F.col(PREFIX + self.statistic) <= at

    def holds(self, values: np.ndarray) -> np.ndarray:
        column = values[:, RATES.index(self.statistic)]
        return column > self.threshold if self.above else column <= self.threshold


@dataclass(frozen=True)
class Rule:
    """A conjunction of terms under which documents are rejected."""

    terms: tuple[Term, ...]
    precision: float
    covered: int

    def holds(self, values: np.ndarray) -> np.ndarray:
        return np.logical_and.reduce([t.holds(values) for t in self.terms]) if self.terms else np.ones(len(values), bool)


def _grow(values: np.ndarray, bad: np.ndarray) -> tuple[Term, ...]:
    """Add the term of largest gain until no good example is covered or no term gains."""
    terms: list[Term] = []
    inside = np.ones(len(bad), bool)
    while len(terms) < MAX_TERMS:
        hits, misses = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not misses or not hits:
            break
        before = math.log2(hits / (hits + misses))
        best: tuple[float, Term] | None = None
        for k, name in enumerate(RATES):
            column = values[inside, k]
            cuts = np.unique(np.quantile(column, np.linspace(0, 1, THRESHOLDS + 2), method="lower"))
            # a cut lies halfway to the next value seen, so that margins do not depend on one example
            later = np.searchsorted(ordered := np.unique(column), cuts, side="right")
            cuts = np.unique((cuts + ordered[np.minimum(later, len(ordered) - 1)]) / 2)
            low = column[:, None] <= cuts[None, :]
            flag = bad[inside][:, None]
            below_bad, below_good = (low & flag).sum(0), (low & ~flag).sum(0)
            for above, p, n in ((False, below_bad, below_good), (True, hits - below_bad, misses - below_good)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), 0.0)
                at = int(np.argmax(gain))
                if gain[at] > 1e-9 and (best is None or gain[at] > best[0] + 1e-12):
                    best = (float(gain[at]), Term(name, above, float(cuts[at])))
        if best is None:
            break
        terms.append(best[1])
        inside &= best[1].holds(values)
    return tuple(terms)


def _prune(terms: tuple[Term, ...], values: np.ndarray, bad: np.ndarray) -> tuple[Term, ...]:
    """The leading terms with the best balance of hits and misses on examples not used for growing."""

    def worth(kept: tuple[Term, ...]) -> float:
        covered = Rule(kept, 0, 0).holds(values)
        hits, misses = (covered & bad).sum(), (covered & ~bad).sum()
        return float((hits - misses) / (hits + misses)) if hits + misses else -1.0

    return max((terms[:k] for k in range(1, len(terms) + 1)), key=lambda kept: (worth(kept), -len(kept)))


def cover(values: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """Sequential covering: an ordered list of rules that reject, each of proven precision."""
    rules: list[Rule] = []
    third = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES and (left & bad & ~third).sum() >= MIN_COVER:
        grown = _grow(values[left & ~third], bad[left & ~third])
        if not grown:
            break
        terms = _prune(grown, values[left & third], bad[left & third])
        rule = Rule(terms, 0.0, 0)
        covered = rule.holds(values) & left
        hits, total = int((covered & bad).sum()), int(covered.sum())
        if total < MIN_COVER or hits / total < MIN_PRECISION:
            terms = grown
            covered = Rule(terms, 0.0, 0).holds(values) & left
            hits, total = int((covered & bad).sum()), int(covered.sum())
            if total < MIN_COVER or hits / total < MIN_PRECISION:
                break
        rules.append(Rule(terms, hits / total, total))
        left &= ~covered
    return rules


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from the labelled documents that pass the base rules.

    ``labels`` has ``doc_id`` and ``quality``; contradicting labels of one id are left out.  At most
    ``sample_rows`` ids, the smallest by hash, take part: a proven bound for the broadcast of ids and
    for the numbers the driver learns from.
    """
    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_low"), F.max("quality").alias("_high"))
        .where(F.col("_low") == F.col("_high"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
        .select("doc_id", F.col("_low").alias("_label"))
    )
    labelled = statistics(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"))
    rows = (
        labelled.where(~F.col("base_failed"))
        .select(F.xxhash64("doc_id").alias("_at"), "doc_id", "_label", *(PREFIX + r for r in RATES))
        .orderBy("_at", "doc_id", *(PREFIX + r for r in RATES))
        .limit(sample_rows)
        .collect()
    )
    if not rows:
        return []
    values = np.array([r[3:] for r in rows], float)
    return cover(values, np.array([r[2] == 0 for r in rows]))


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression over ``statistics``: first matching rule decides."""
    decided = F.when(F.col("base_failed"), F.lit(False))
    for rule in rules:
        condition = rule.terms[0].column()
        for term in rule.terms[1:]:
            condition = condition & term.column()
        decided = decided.when(condition, F.lit(False))
    return decided.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with the five counts, ``base_failed`` and ``kept``; these take the place of columns of their names."""
    row = unused(docs, "row")
    judged = _judged(docs, rules, row)
    results = [c for c in judged.columns if c not in (row, "text")]
    own = [F.col(f"{row}.`{c}`").alias(c) for c in docs.columns if c not in results]
    return judged.select(*own, *results)


def passed(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns unchanged, whatever their names."""
    row = unused(docs, "row")
    return _judged(docs, rules, row).where("kept").select(*(F.col(f"{row}.`{c}`").alias(c) for c in docs.columns))


def _judged(docs: DataFrame, rules: list[Rule], row: str) -> DataFrame:
    """Counts and verdict beside the whole row as one column, so that names cannot clash."""
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row), "text")
    return statistics(packed).withColumn("kept", verdict(rules)).drop(*(PREFIX + r for r in RATES))
