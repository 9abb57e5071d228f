"""Quality rules by weak supervision: rules vote or abstain, one probability decides.

Every rule looks at counts of the whole text and says good (1), bad (-1) or nothing (0). How
far each rule is to be believed is not set by hand: expectation-maximisation over all
documents estimates, per rule, how often it votes either way on good and on bad documents,
and the share of good ones. A document is kept where its posterior probability of being good
reaches ``threshold``; so one vote of a rule that hardly ever errs can outweigh several of
rules that say good to nearly everything, and no rule alone has to pass.

Scale: the votes of a document are one of 3^rules patterns. Spark counts the patterns (a
partial aggregate, so hot patterns cost nothing) and only these counts, at most 3^8 rows by
label whatever the input, reach the driver, where the iterations run. The posterior goes back as a
column expression with the estimated numbers as literals: no join, no second shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored, words_of

WINDOW = 8  # words
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _pairs(c: str, k: int) -> Column:
    """Hash of element i and element i + k of array ``c``, for every i that has both."""
    n = F.greatest(F.size(c) - k, F.lit(0))
    return F.zip_with(F.slice(c, 1, n), F.slice(c, k + 1, n), lambda a, b: F.xxhash64(a, b))


def _next_to(c: str, f) -> Column:
    """``f`` of each element of array ``c`` and the one after it."""
    n = F.greatest(F.size(c) - 1, F.lit(0))
    return F.zip_with(F.slice(c, 1, n), F.slice(c, 2, n), f)


def _removed(text: Column, chars: str) -> Column:
    """How many code points of ``text`` are among ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def with_features(docs: DataFrame, text_col: str = "text", out: str = "features") -> DataFrame:
    """``docs`` and a struct column of counts over each whole text (null text: no word).

    Of ``BASE``: words; code points in words; symbols; lines with a word that equal an earlier
    line; words inside 8-word windows that are found at least twice in the text (windows are
    compared by a 64-bit hash of their words). Each array is made once and read twice at most,
    so a text of n words costs n steps, not n * n. Only documents with a repeated window sort.
    """
    t, w = F.col("t"), F.col("w")
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                    F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    d = d.withColumn("w", words_of(t)).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    d = d.withColumn("h2", _pairs("h", 1)).withColumn("h4", _pairs("h2", 2)).withColumn("h8", _pairs("h4", 4))
    # windows found twice: sort (hash, place) and compare neighbours
    d = d.withColumn("s", F.when(
        F.size(F.array_distinct("h8")) < F.size("h8"),
        F.sort_array(F.transform("h8", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
    ))
    d = d.withColumn("eq", _next_to("s", lambda a, b: a["h"] == b["h"]))
    d = d.withColumn("f", F.zip_with(
        F.concat(F.array(F.lit(False)), "eq"), F.concat("eq", F.array(F.lit(False))), lambda a, b: a | b,
    ))
    d = d.withColumn("p", F.sort_array(F.filter(
        F.zip_with("s", "f", lambda a, f: F.when(f, a["i"])), lambda x: x.isNotNull(),
    )))
    covered = F.aggregate(
        _next_to("p", lambda a, b: F.least(b - a, F.lit(WINDOW)).cast("long")),
        F.lit(WINDOW).cast("long"), lambda total, x: total + x,
    )
    d = d.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: F.trim(F.translate(x, "\t\u000b\f\r", "    ")) != ""))
    features = F.struct(
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate(t, " \t\n\u000b\f\r", "")).cast("long").alias("word_chars"),
        _removed(t, SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("h")).cast("long").alias("n_distinct"),
        _removed(t, UPPER).alias("n_upper"),
        _removed(t, "!").alias("n_calls"),
        F.size(F.filter("lines", lambda x: F.rtrim(x).rlike("[.!?:…\"'”»)]$"))).cast("long").alias("n_ended"),
    )
    return d.select("row.*", features.alias(free_name(docs, out)))


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains.

    Both are SQL conditions over the feature names; null counts as false."""

    name: str
    bad: str
    good: str


#: Rules are about form only, in any language written with spaces.
RULES = (
    Rule("symbols", "n_symbols > 0.2 * n_words", "n_symbols < 0.05 * n_words"),
    Rule("repeated_words", "n_repeat_words > 0.3 * n_words", "n_repeat_words < 0.1 * n_words"),
    Rule("repeated_lines", "n_dup_lines > 0.4 * n_lines", "n_dup_lines < 0.1 * n_lines and n_lines > 2"),
    Rule("word_length", "word_chars < 2.5 * n_words or word_chars > 10 * n_words", "word_chars between 4 * n_words and 7 * n_words"),
    Rule("capitals", "n_upper > 0.4 * word_chars", "n_upper < 0.15 * word_chars"),
    Rule("calls", "n_calls > 0.5 * n_words", "n_calls < 0.1 * n_words"),
    Rule("vocabulary", "n_words >= 20 and n_distinct < greatest(0.1, 0.3 - 0.001 * n_words) * n_words", "n_distinct > 0.25 * n_words"),
    Rule("line_ends", "n_lines > 2 and n_ended < 0.1 * n_lines", "n_ended >= 0.8 * n_lines"),
)


def votes(features: str, rules: Sequence[Rule] = RULES) -> Column:
    """The votes of one document as a pattern number: base-3 digits, vote + 1 each."""

    def vote(r: Rule) -> Column:
        held = [F.coalesce(F.expr(_qualified(c, features)), F.lit(False)) for c in (r.bad, r.good)]
        return F.when(held[0], F.lit(0)).when(held[1], F.lit(2)).otherwise(F.lit(1))

    total: Column = F.lit(0)
    for j, r in enumerate(rules):
        total = total + vote(r) * F.lit(3**j)
    return total.cast("int")


def _qualified(condition: str, features: str) -> str:
    return re.sub(r"\b(n_\w+|word_chars)\b", rf"`{features}`.\1", condition)


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents and how often each rule is right when it votes.

    ``right[c][j]``: class c (0 bad, 1 good), rule j. Abstaining says nothing of the class (it
    follows length and the like), so it has no chance of its own.
    """

    good: float
    right: tuple

    def log_odds(self, pattern: Column) -> Column:
        """Log-odds of good for a column of pattern numbers."""
        total: Column = F.lit(math.log(self.good / (1 - self.good)))
        for j, (on_bad, on_good) in enumerate(zip(*self.right)):
            digit = F.pmod(F.floor(pattern / F.lit(3**j)), F.lit(3))
            against, in_favour = math.log((1 - on_good) / on_bad), math.log(on_good / (1 - on_bad))
            total = total + F.when(digit == 0, against).when(digit == 2, in_favour).otherwise(0.0)
        return total


@dataclass(frozen=True)
class KindModel:
    """Good documents (class 0) and one class per kind of bad ones.

    ``shares[c]``: share of class c; ``bad[c][j]``: chance that rule j votes bad there, if it votes."""

    shares: tuple
    bad: tuple

    def log_odds(self, pattern: Column) -> Column:
        """Log-odds of good for a column of pattern numbers."""
        def log_chance(c: int) -> Column:
            total: Column = F.lit(math.log(self.shares[c]))
            for j, b in enumerate(self.bad[c]):
                digit = F.pmod(F.floor(pattern / F.lit(3**j)), F.lit(3))
                total = total + F.when(digit == 0, math.log(b)).when(digit == 2, math.log(1 - b)).otherwise(0.0)
            return total

        kinds = [F.exp(log_chance(c)) for c in range(1, len(self.shares))]
        return log_chance(0) - F.log(reduce(add, kinds))


def fit(counts: dict[int, int], n_rules: int, rounds: int = 100, false_alarms: float = 0.001) -> VoteModel:
    """Expectation-maximisation over pattern counts; an empty input keeps the starting model.

    Starts from: nine in ten are good; rules are written to spare good documents (99.9 %) and
    each is about one kind of bad document (a quarter of them). One vote of each kind is
    added, so no chance reaches 0 or 1. Kinds of bad documents exclude each other, so most
    rules call any bad document good; ``false_alarms`` bounds the share of good documents a
    rule may be estimated to call bad, which keeps a kind that only one rule sees from
    passing for good.
    """
    right, good = np.stack([np.full(n_rules, 0.25), np.full(n_rules, 1 - false_alarms)]), 0.9
    if counts:
        keys = np.array(sorted(counts))
        n = np.array([counts[k] for k in keys], float)
        digits = keys[:, None] // 3 ** np.arange(n_rules) % 3
        bad_vote, good_vote = digits == 0, digits == 2
        for _ in range(rounds):
            against, in_favour = np.log((1 - right[1]) / right[0]), np.log(right[1] / (1 - right[0]))
            odds = bad_vote @ against + good_vote @ in_favour + np.log(good / (1 - good))
            post = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
            is_bad, is_good = n * (1 - post), n * post
            right = np.stack([
                (is_bad @ bad_vote + 1) / (is_bad @ (bad_vote | good_vote) + 2),
                np.maximum((is_good @ good_vote + 1) / (is_good @ (bad_vote | good_vote) + 2), 1 - false_alarms),
            ])
            good = float((is_good.sum() + 1) / (n.sum() + 2))
    return VoteModel(good, tuple(tuple(map(float, c)) for c in right))


def fit_kinds(
    counts: dict[int, int], anchors: dict[int, tuple[int, int]], n_rules: int, tolerance: float = 1e-9,
) -> KindModel:
    """Expectation-maximisation where some documents are labelled, until nothing moves by ``tolerance``.

    ``counts``: unlabelled documents by pattern; ``anchors``: labelled ones, (bad, good) by pattern.
    Kinds of bad documents exclude each other: one that a single rule sees is praised by all the
    others. So every rule starts a kind of its own, which it nearly always finds and the others
    mostly do not, and good documents start as the labelled ones vote. A good label holds its class in every round, a bad one
    is shared among the kinds. All chances are estimated, with one vote of each sort added; none is bounded.
    """
    keys = np.array(sorted(set(counts) | set(anchors)), np.int64)
    free = np.array([counts.get(int(k), 0) for k in keys], float)
    known_bad, known_good = np.array([anchors.get(int(k), (0, 0)) for k in keys], float).T
    digits = keys[:, None] // 3 ** np.arange(n_rules) % 3
    bad_vote, good_vote = (digits == 0).astype(float), (digits == 2).astype(float)

    def chances(weight: np.ndarray) -> np.ndarray:
        return (weight.T @ bad_vote + 1) / (weight.T @ (bad_vote + good_vote) + 2)

    bad = np.full((n_rules + 1, n_rules), 0.05)
    bad[0] = chances(known_good[:, None])[0]
    bad[np.arange(n_rules) + 1, np.arange(n_rules)] = 0.9
    shares = np.append(0.9, np.full(n_rules, 0.1 / n_rules))
    moved = np.inf
    while moved > tolerance:
        joint = np.exp(bad_vote @ np.log(bad).T + good_vote @ np.log(1 - bad).T + np.log(shares))
        weight = joint / joint.sum(axis=1, keepdims=True) * free[:, None]
        weight[:, 0] += known_good
        weight[:, 1:] += joint[:, 1:] / joint[:, 1:].sum(axis=1, keepdims=True) * known_bad[:, None]
        before = bad, shares
        bad, shares = chances(weight), (weight.sum(axis=0) + 1) / (weight.sum() + n_rules + 1)
        moved = max(float(np.abs(bad - before[0]).max()), float(np.abs(shares - before[1]).max()))
    return KindModel(tuple(map(float, shares)), tuple(tuple(map(float, c)) for c in bad))


def _tallies(
    voted: DataFrame, pattern: str, id_col: str, labels: DataFrame | None,
) -> tuple[dict[int, int], dict[int, tuple[int, int]]]:
    """(pattern counts of unlabelled documents, (bad, good) counts of labelled ones).

    At most three rows a pattern leave Spark. A document whose label rows disagree is unlabelled."""
    if labels is None:
        return {r[0]: r[1] for r in voted.groupBy(pattern).count().collect()}, {}
    known = labels.select(F.col(labels.columns[0]).alias("label_id"), F.col(labels.columns[1]).cast("boolean").alias("label"))
    known = known.filter("label_id is not null and label is not null").groupBy("label_id").agg(
        F.min("label").alias("label"), F.max("label").alias("other"))
    known = known.filter("label = other").drop("other")
    narrow = voted.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{pattern}`").alias("pattern"))
    rows = narrow.join(known, F.col("id") == F.col("label_id"), "left").groupBy("pattern", "label").count().collect()
    counts, anchors = {}, {}
    for p, label, n in rows:
        if label is None:
            counts[p] = n
        else:
            bad, good = anchors.get(p, (0, 0))
            anchors[p] = (bad, good + n) if label else (bad + n, good)
    return counts, anchors


def judged(
    docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, threshold: float = 0.5,
    keep: Sequence[str] | None = None, labels: DataFrame | None = None, id_col: str = "doc_id",
) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with a struct column ``quality``.

    Its fields: ``features``, ``base_failed`` (under 20 words, or more than 30 % of the words
    in repeated windows), ``good`` (posterior probability) and ``kept`` (false if base_failed,
    else ``good`` >= threshold). The struct's name gets an underscore where it is taken.
    Null and empty texts fail the base; a null in any other column changes nothing; repeated
    rows get equal verdicts; an empty table gives an empty result.

    ``labels``: rows (id, 1 for good or 0 for bad) for ``fit_kinds``; all are used, ids are those
    of ``id_col`` (which ``keep`` must hold then). Where no document of one class is labelled,
    ``fit`` estimates without them. A label changes verdicts through the estimate alone.
    """
    columns = list(docs.columns if keep is None else keep)
    seen = with_features(docs, text_col)
    features = seen.columns[-1]
    pattern = free_name(seen, "pattern")
    # one pass over the texts; what follows reads this table
    table = stored(seen.select(*[F.col(f"`{c}`") for c in columns], features).withColumn(pattern, votes(features, rules)), "quality")
    counts, anchors = _tallies(table, pattern, id_col, labels)
    bad, good_ones = (sum(a[c] for a in anchors.values()) for c in (0, 1))
    if bad and good_ones:
        model = fit_kinds(counts, anchors, len(rules))
    else:
        for p, a in anchors.items():
            counts[p] = counts.get(p, 0) + sum(a)
        model = fit(counts, len(rules))
    f = F.col(features)
    base_failed = (f["n_words"] < 20) | (100 * f["n_repeat_words"] > 30 * f["n_words"])
    good = 1 / (1 + F.exp(-model.log_odds(F.col(pattern))))
    quality = F.struct(
        f.alias("features"), base_failed.alias("base_failed"), good.alias("good"),
        (~base_failed & (good >= threshold)).alias("kept"),
    )
    name = free_name(docs.select(*[F.col(f"`{c}`") for c in columns]), "quality")
    return table.select(*[F.col(f"`{c}`") for c in columns], quality.alias(name))
