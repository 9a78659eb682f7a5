"""Quality rules as a short-circuit cascade.

Each rule is a boolean column over the text that says "reject". A sample tells what each rule
costs (seconds of a job over the sample, less those of a bare scan) and how the rules overlap
(counts of verdict patterns, at most 2**rules rows). Rules are then ordered greedily by rejected
documents per second among what the earlier rules let through, and evaluated in that order by one
CASE, which stops at the first rule that rejects. The order never changes a verdict, only the
work, so the sample has no bearing on results.

Defined cases: null text counts as empty; the empty text has no words and fails ``few_words``;
a rule that yields null does not reject. Rows are judged one by one, so repeated rows, ties and
very long texts need no care; an empty table keeps the given order. Input columns named like an
output column are replaced.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitlens.session import materialize

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"


def words_of(text: Column) -> Column:
    """Words parted by space, tab, newline, vertical tab, form feed or return."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def count_chars(text: Column, pattern: str) -> Column:
    """Characters of a class given as a pattern."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(pattern)).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return _bound(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def window_hashes(words: Column, k: int) -> Column:
    """A hash of each window of k words; empty for shorter texts."""
    last = F.size(words) - (k - 1)
    every = F.transform(F.sequence(F.lit(0), last - 1),
                        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
    return F.when(last > 0, every).otherwise(F.array().cast("array<bigint>"))


def repeated_words(words: Column, hashes: Column, k: int = 5) -> Column:
    """Words inside windows of k words that occur twice or more in the text.

    The hashes (``window_hashes``) tell whether anything repeats. Only then are (hash, position)
    pairs sorted, so equal windows stand side by side, and confirmed word by word.
    """
    pairs = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def of_pairs(s: Column) -> Column:
        def same(x: Column, y: Column) -> Column:
            equal = F.slice(words, x["i"] + 1, k) == F.slice(words, y["i"] + 1, k)
            return F.coalesce(F.when(x["h"] == y["h"], equal), F.lit(False))

        twice = F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            starts, zero,
            lambda a, p: F.struct((a["n"] + (p + k) - F.greatest(p, a["end"])).alias("n"), (p + k).alias("end")),
            lambda a: a["n"])

    again = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(again, _bound(pairs, of_pairs)).otherwise(F.lit(0)).cast("long")


class Features:
    """What rules look at, made from the text where it is asked for."""

    def __init__(self, text: Column):
        self.text = F.coalesce(text, F.lit(""))

    def n_words(self) -> Column:
        return F.size(words_of(self.text))

    def n_symbols(self) -> Column:
        return count_chars(self.text, SYMBOLS)

    def n_dup_lines(self) -> Column:
        return duplicate_lines(self.text)

    def n_repeat_words(self) -> Column:
        return _bound(words_of(self.text),
                      lambda w: _bound(window_hashes(w, 5), lambda h: repeated_words(w, h, 5)))


class ColumnFeatures(Features):
    """The same, taken from columns that are there already."""

    def n_words(self) -> Column:
        return F.col("n_words")

    def n_symbols(self) -> Column:
        return F.col("n_symbols")

    def n_dup_lines(self) -> Column:
        return F.col("n_dup_lines")

    def n_repeat_words(self) -> Column:
        return F.col("n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A named rejection: ``rejects`` makes the boolean column from the features."""

    name: str
    rejects: Callable[[Features], Column]


def few_words(least: int = 10) -> Rule:
    return Rule("few_words", lambda f: f.n_words() < least)


def repetitive(percent: int = 20) -> Rule:
    return Rule("repetitive", lambda f: 100 * f.n_repeat_words() > percent * f.n_words())


def symbol_heavy(percent_of_words: int = 10) -> Rule:
    return Rule("symbol_heavy", lambda f: 100 * f.n_symbols() > percent_of_words * f.n_words())


def shouting(percent: int = 30) -> Rule:
    """Capital letters A-Z above a share of all characters."""
    return Rule("shouting", lambda f: 100 * count_chars(f.text, "[A-Z]") > percent * F.length(f.text))


def exclaiming(percent_of_words: int = 20) -> Rule:
    return Rule("exclaiming", lambda f: 100 * count_chars(f.text, "!") > percent_of_words * f.n_words())


def duplicated_lines(percent: int = 60) -> Rule:
    return Rule("duplicated_lines",
                lambda f: 100 * f.n_dup_lines() > percent * (F.regexp_count(f.text, F.lit("\n")) + 1))


def stuttering(percent: int = 30) -> Rule:
    """Words equal to the word before them above a share of all words."""
    def rejects(f: Features) -> Column:
        def many(w: Column) -> Column:
            return 100 * F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))) > percent * F.size(w)

        return _bound(words_of(f.text), many)

    return Rule("stuttering", rejects)


STANDARD = (few_words(), repetitive(), symbol_heavy(), shouting(), exclaiming(), duplicated_lines(), stuttering())


def order_rules(docs: DataFrame, rules: Sequence[Rule], text: str = "text", sample_rows: int = 500, seed: int = 7,
                features: type[Features] = Features, prepare: Callable[[DataFrame], DataFrame] | None = None,
                among: str | None = None) -> list[Rule]:
    """The rules by rejection per cost, estimated on about ``sample_rows`` rows.

    A rule is timed as it will run: on ``features``, and on the columns that ``prepare`` gives the sampled rows; ``among``
    keeps those of them that reach the rules at all.
    Costs count as powers of two, so that the order does not follow small differences of the clock. Drawing the
    sample reads the table once, which the order of rules then has to earn back; it decides nothing else.
    """
    if len(rules) < 2:
        return list(rules)
    total = docs.count()
    share = min(1.0, sample_rows / max(total, 1))
    drawn = docs.sample(share, seed).withColumn("text", F.col(text))
    sample = materialize(prepare(drawn) if prepare else drawn, "rules-sample")
    if among:
        sample = materialize(sample.where(among), "rules-sample")
    verdicts = [F.coalesce(r.rejects(features(F.col("text"))), F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules)]

    def seconds(column: Column) -> float:
        took = []
        for _ in range(2):
            began = time.perf_counter()
            sample.agg(F.sum(column)).collect()
            took.append(time.perf_counter() - began)
        return min(took)

    bare = seconds(F.length("text"))
    costs = [2.0 ** round(math.log2(max(seconds(v.cast("int")) - bare, 1e-3))) for v in verdicts]
    patterns = sample.select(*verdicts).groupBy(*[f"r{i}" for i in range(len(rules))]).count().collect()
    left, order, open_rules = [(tuple(p)[:-1], p["count"]) for p in patterns], [], list(range(len(rules)))
    while open_rules:
        best = max(open_rules, key=lambda i: (sum(n for bits, n in left if bits[i]) / costs[i], -costs[i], -i))
        order.append(best)
        open_rules.remove(best)
        left = [(bits, n) for bits, n in left if not bits[best]]
    return [rules[i] for i in order]


def first_rejection(rules: Sequence[Rule], features: Features) -> Column:
    """The name of the first rule that rejects, else null; later rules are not evaluated."""
    chain = None
    for rule in rules:
        hit = rule.rejects(features)
        chain = F.when(hit, F.lit(rule.name)) if chain is None else chain.when(hit, F.lit(rule.name))
    return F.lit(None).cast("string") if chain is None else chain


def judge(docs: DataFrame, rules: Sequence[Rule] = STANDARD, text: str = "text", **sampling: int) -> DataFrame:
    """All rows with ``rejected_by`` (null: kept) and ``kept``."""
    ordered = order_rules(docs, rules, text, **sampling)
    out = docs.withColumn("rejected_by", first_rejection(ordered, Features(F.col(text))))
    return out.withColumn("kept", F.col("rejected_by").isNull())


def keep_good(docs: DataFrame, rules: Sequence[Rule] = STANDARD, text: str = "text", **sampling: int) -> DataFrame:
    """Only the rows that no rule rejects, columns unchanged."""
    ordered = order_rules(docs, rules, text, **sampling)
    return docs.where(first_rejection(ordered, Features(F.col(text))).isNull())
