"""Quality by weak supervision: rules vote or abstain, a label model weighs them.

Every rule looks at one statistic of a text and votes "bad" (1), "good" (0) or abstains
(null).  How often the rules agree says how accurate each is: expectation-maximisation
over the counts of vote patterns estimates, without labels, the share of bad documents
and each rule's chance of a "bad" vote in either class.  A document stays if its
posterior probability of being good is at least ``min_posterior`` and no base rule
fails.  One odd statistic alone thus does not drop a text, as all-must-pass would.

Only the pattern counts reach the driver: at most 3**10 rows, whatever the corpus.  All
else is built-in column functions; the fitted model is a sum of literals.

Defined results: a null text is empty, has no words and fails the base; repeated rows
count as often as they come; an empty table fits the starting values and gives no rows.
A text's windows are compared by 64-bit hash within the text.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gaugemill.llm.common import materialize, white_words

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Share of good documents in which a rule may vote bad: what a rule's author answers for.
MAX_FALSE_ALARM = 0.02

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: Callable[[], Column]
    good: Callable[[], Column]


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


RULES = [
    Rule("symbols", lambda: _share("n_symbols", "word_chars") > 0.06,
         lambda: _share("n_symbols", "word_chars") < 0.02),
    Rule("letters", lambda: 1 - _share("n_signs", "word_chars") < 0.9,
         lambda: 1 - _share("n_signs", "word_chars") > 0.93),
    Rule("marks", lambda: (F.col("n_symbols") + F.col("n_exclaims")) / F.greatest("n_words", F.lit(1)) > 0.3,
         lambda: (F.col("n_symbols") + F.col("n_exclaims")) / F.greatest("n_words", F.lit(1)) < 0.1),
    Rule("dup_lines", lambda: _share("n_dup_lines", "n_lines") > 0.3,
         lambda: F.col("n_dup_lines") == 0),
    Rule("repeats", lambda: _share("n_repeat_words", "n_words") > 0.2,
         lambda: _share("n_repeat_words", "n_words") < 0.02),
    Rule("capitals", lambda: _share("n_capitals", "word_chars") > 0.35,
         lambda: _share("n_capitals", "word_chars") < 0.1),
    Rule("exclaims", lambda: _share("n_exclaims", "n_words") > 0.2,
         lambda: _share("n_exclaims", "n_words") < 0.03),
    Rule("length", lambda: F.col("n_words") < MIN_WORDS, lambda: F.col("n_words") >= 40),
    Rule("word_length", lambda: ~_share("word_chars", "n_words").between(2.5, 12),
         lambda: _share("word_chars", "n_words").between(3, 9)),
    Rule("variety", lambda: (F.col("n_words") >= MIN_WORDS) & (_share("n_distinct", "n_words") < 0.1),
         lambda: _share("n_distinct", "n_words") > 0.25),
]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs more than once; ``hashes`` is in text order."""

    def repeated(s: Column) -> Column:
        return F.filter(
            s,
            lambda x, i: (F.get(s, i + 1)["h"] == x["h"]).eqNullSafe(F.lit(True))
            | (F.get(s, i - 1)["h"] == x["h"]).eqNullSafe(F.lit(True)),
        )

    def union(p: Column) -> Column:
        steps = F.transform(
            p, lambda x, i: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW_WORDS)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    positions = _let(ordered, lambda s: F.sort_array(F.transform(repeated(s), lambda x: x["i"])))
    return _let(positions, union)


def with_statistics(docs: DataFrame, prefix: str = "_q_") -> DataFrame:
    """``docs`` (text) with the statistics of each whole text in columns named ``prefix`` + name."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Capitals, digits and signs of ASCII only: short, so cheap to count in.
    marks = F.regexp_replace(text, r"[^!-`{-~]+", "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    split = docs.select(
        "*",
        white_words(text).alias(f"{prefix}words"),
        lines.alias(f"{prefix}lines"),
        marks.alias(f"{prefix}marks"),
    )
    words, line, mark = (F.col(prefix + x) for x in ("words", "lines", "marks"))
    n = F.size(words)
    only = {k: F.length(F.regexp_replace(mark, f"[^{c}]+", "")) for k, c in
            (("n_symbols", SYMBOLS), ("n_capitals", "A-Z"), ("n_exclaims", "!"),
             ("n_signs", r"!-/:-@\[-`{-~"))}
    counted = split.select(
        *docs.columns,
        *(x.cast("long").alias(prefix + k) for k, x in only.items()),
        n.cast("long").alias(f"{prefix}n_words"),
        F.length(F.array_join(words, "")).cast("long").alias(f"{prefix}word_chars"),
        F.size(F.array_distinct(words)).cast("long").alias(f"{prefix}n_distinct"),
        F.size(line).cast("long").alias(f"{prefix}n_lines"),
        (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias(f"{prefix}n_dup_lines"),
        F.transform(words, lambda w: F.xxhash64(w)).alias(f"{prefix}h1"),
    )
    # Hashes of 2, 4 and 8 words in a row, each from two of half as many.
    for span in (1, 2, 4):
        half = F.col(f"{prefix}h{span}")
        ahead = F.zip_with(
            F.slice(half, 1, F.greatest(F.size(half) - span, F.lit(0))),
            F.slice(half, span + 1, F.greatest(F.size(half) - span, F.lit(0))),
            lambda a, b: F.xxhash64(a, b),
        )
        counted = counted.withColumn(f"{prefix}h{2 * span}", ahead).drop(f"{prefix}h{span}")
    windows = F.col(f"{prefix}h{WINDOW_WORDS}")
    again = F.size(F.array_distinct(windows)) < F.size(windows)
    # The row number's only use is that filters stay above it: pushed below, a filter on
    # statistics would compute them anew for each time it names them.
    return counted.select(
        "*",
        F.when(again, _covered(windows)).otherwise(F.lit(0)).cast("long").alias(f"{prefix}n_repeat_words"),
        F.monotonically_increasing_id().alias(f"{prefix}row"),
    ).drop(f"{prefix}h{WINDOW_WORDS}")


def _named(columns: list[str], prefix: str) -> list[Column]:
    return [F.col(c).alias(c.removeprefix(prefix)) for c in columns if c.startswith(prefix)]


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics) of every document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = with_statistics(narrow)
    return found.select("doc_id", *_named(found.columns, "_q_")).drop("row")


def vote(rule: Rule) -> Column:
    return F.when(rule.bad(), 1).when(rule.good(), 0).cast("int")


@dataclass(frozen=True)
class LabelModel:
    """Share of bad documents; per rule the chance of a bad vote in bad and in good ones."""

    bad_share: float
    chances: tuple[tuple[float, float], ...]

    def posterior(self, votes: list[Column]) -> Column:
        """Probability that a document is good, given its votes."""
        odds = F.lit(math.log(self.bad_share / (1 - self.bad_share)))
        for v, (in_bad, in_good) in zip(votes, self.chances):
            odds = odds + F.when(v == 1, math.log(in_bad / in_good)).when(
                v == 0, math.log((1 - in_bad) / (1 - in_good))
            ).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(odds))


def fit(patterns: list[tuple[tuple[int | None, ...], int]], rounds: int = 60) -> LabelModel:
    """Expectation-maximisation over (votes, documents) pairs.

    Starts from "bad if any rule says so".  Rules are held to be better than chance and
    to be written with care: a bad vote is never likelier in good documents than in bad
    ones, nor likelier there than MAX_FALSE_ALARM.
    """
    n_rules = len(patterns[0][0]) if patterns else len(RULES)
    bad = [0.9 if 1 in votes else 0.02 for votes, _ in patterns]
    model = LabelModel(0.1, tuple((0.5, 0.02) for _ in range(n_rules)))
    for _ in range(rounds if patterns else 0):
        total = sum(n for _, n in patterns)
        share = (sum(q * n for q, (_, n) in zip(bad, patterns)) + 1) / (total + 10)
        chances = []  # of a bad vote, in bad and in good documents
        for j in range(n_rules):
            said = [[1.0, 1.0], [0.1, 9.9]]  # pseudo-counts: (bad, good) votes by class
            for q, (votes, n) in zip(bad, patterns):
                if votes[j] is not None:
                    said[0][1 - votes[j]] += q * n
                    said[1][1 - votes[j]] += (1 - q) * n
            in_bad, in_good = (min(max(a / (a + b), 1e-5), 1 - 1e-5) for a, b in said)
            chances.append((max(in_bad, in_good), min(in_good, MAX_FALSE_ALARM)))
        model = LabelModel(min(max(share, 1e-6), 0.5), tuple(chances))
        bad = [1 - _good(model, votes) for votes, _ in patterns]
    return model


def _good(model: LabelModel, votes: tuple[int | None, ...]) -> float:
    odds = math.log(model.bad_share / (1 - model.bad_share))
    for v, (in_bad, in_good) in zip(votes, model.chances):
        if v is not None:
            odds += math.log(in_bad / in_good) if v else math.log((1 - in_bad) / (1 - in_good))
    return 1 / (1 + math.exp(min(odds, 700)))


def fit_counts(stats: DataFrame) -> LabelModel:
    """Fit to all rows of a table of statistics, by their pattern counts."""
    votes = [vote(r).alias(r.name) for r in RULES]
    names = [r.name for r in RULES]
    rows = stats.select(*votes).groupBy(*names).count().collect()
    ordered = sorted(rows, key=lambda r: tuple(-1 if v is None else v for v in r[:-1]))
    return fit([(tuple(r[:-1]), r[-1]) for r in ordered])


def judged(stats: DataFrame, model: LabelModel, min_posterior: float = 0.5) -> DataFrame:
    """Statistics with votes, ``posterior`` (of being good), ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    votes = [vote(r).alias(f"vote_{r.name}") for r in RULES]
    voted = stats.select("*", *votes).withColumn("base_failed", failed)
    posterior = model.posterior([F.col(f"vote_{r.name}") for r in RULES])
    return voted.withColumn("posterior", posterior).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= min_posterior)
    )


def verdicts(docs: DataFrame, min_posterior: float = 0.5) -> DataFrame:
    """doc_id, statistics, votes, posterior, base_failed and kept of every document."""
    stats = materialize(statistics(docs), "quality")
    return judged(stats, fit_counts(stats), min_posterior)


def keep_good(docs: DataFrame, min_posterior: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, columns unchanged.

    The statistics are computed once to fit and once to decide: whole texts are neither
    stored nor shuffled.
    """
    model = fit_counts(statistics(docs))
    slot = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    held = with_statistics(docs.select(slot, F.col("text")))
    stats = held.select("_doc", *_named(held.columns, "_q_"))
    return judged(stats, model, min_posterior).filter("kept and row >= 0").select("_doc.*")
