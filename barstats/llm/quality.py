"""Quality by weak supervision: rules vote or abstain, and the votes are weighed.

Every rule says good (1), bad (-1) or nothing (0) about a document. Expectation-
maximisation over the counts of the vote patterns of all documents estimates how accurate
each rule is, on good documents and on bad ones, and what share of documents is good; a document's
posterior probability of being good decides, not whether it passes every rule. Only
DataFrame functions are used.

There are at most 3 ** rules patterns, however many documents; a round of estimation is one
aggregate of them and brings 6 numbers a rule to the driver. Documents are read once,
and nothing of them is shuffled but partial counts. A row stands for itself: repeated rows
vote as often as they are there. A null text has no words; it and any other text of fewer
than MIN_WORDS words, or with over MAX_REPEATED percent of words in repeated 8-word windows,
fails whatever the rules say. Texts of any length are taken whole.

Repeated words and windows are told by their 64-bit hashes. In an empty table nothing is estimated or
judged; a posterior of exactly KEEP_FROM is kept. A column of the input that has
the name of a new one is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstats.llm.common import WORD, set_apart
from barstats.sources.scratch import staged

MIN_WORDS = 20
MAX_REPEATED = 30
WINDOW = 8
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Rules: name, expression for bad, expression for good. Neither: the rule abstains. That a
#: text lacks one fault says little, so rules for single faults never vote good.
RULES = (
    ("short", f"n_words < {MIN_WORDS}", "false"),
    ("symbols", "n_symbols > 0.1 * n_words", "false"),
    ("capitals", "_upper > 0.4 * _letters", "false"),
    ("exclaims", "_exclaims > 0.3 * n_words", "false"),
    ("repeats", f"100 * n_repeat_words > {MAX_REPEATED} * n_words", "false"),
    ("lines", "n_dup_lines > 0.3 * _lines", "false"),
    ("variety", "_distinct < 0.25 * n_words", "_distinct > 0.5 * n_words"),
    ("plain", "_plain < 0.75 * n_words", "_plain >= 0.9 * n_words"),
    ("ends", "_ended < 0.5 * _lines", "_ended >= 0.8 * _lines"),
    ("lengths", "word_chars NOT BETWEEN 3.5 * n_words AND 9 * n_words", "word_chars BETWEEN 4.3 * n_words AND 7 * n_words"),
)
ROUNDS, SETTLED = 200, 1e-6
#: Where the estimate starts: the share of good documents, and how a rule votes (bad,
#: nothing, good) on documents of either kind.
START_GOOD = 0.8
START_ON_GOOD, START_ON_BAD = (0.05, 0.35, 0.6), (0.5, 0.3, 0.2)
KEEP_FROM = 0.5


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with the counts that the rules look at (helpers begin with _)."""
    names = {*FEATURES, "_upper", "_letters", "_lines", "_distinct", "_exclaims", "_plain", "_ended"}
    kept = [c for c in docs.columns if c.lower() not in names]
    rows = docs.select(*kept, F.coalesce(text_col, F.lit("")).alias("_text"))
    rows = rows.select("*", F.regexp_extract_all("_text", F.lit(f"({WORD})"), F.lit(1)).alias("_words"))
    rows = rows.select(
        *kept,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _left("[^#*$%&|<>]+").alias("n_symbols"),
        _left(r"[^\p{Lu}]+").alias("_upper"),
        _left(r"[^\p{L}]+").alias("_letters"),
        (F.length("_text") - F.length(F.replace("_text", F.lit("!")))).cast("long").alias("_exclaims"),
        F.expr(f"filter(split(_text, '\\n'), x -> x rlike r'{WORD}')").alias("_with_word"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
        F.expr(r"size(filter(_words, w -> w rlike r'^\p{L}+[.,;:!?]?$'))").cast("long").alias("_plain"),
    )
    rows = rows.select(
        *kept,
        *(c for c in rows.columns if c in names),
        F.size("_with_word").cast("long").alias("_lines"),
        F.expr("""size(filter(_with_word, x -> right(rtrim(x), 1) IN ('.', '!', '?', ':', '"')))""").cast("long").alias("_ended"),
        (F.size("_with_word") - F.size(F.array_distinct("_with_word"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("_hashes")).cast("long").alias("_distinct"),
        F.expr(
            f"CASE WHEN n_words > {WINDOW} THEN transform(sequence(1, cast(n_words as int) - {WINDOW - 1}),"
            f" i -> xxhash64(slice(_hashes, i, {WINDOW}))) ELSE cast(array() as array<bigint>) END"
        ).alias("_windows"),
    )
    # Only a text with a repeated window has its windows sorted.
    repeated = F.expr(
        "CASE WHEN size(_windows) > size(array_distinct(_windows))"
        " THEN array_sort(transform(_windows, (w, i) -> struct(w AS w, i AS i)))"
        " ELSE cast(array() as array<struct<w:bigint,i:int>>) END"
    )
    rows = rows.select(*(c for c in rows.columns if c != "_windows"), repeated.alias("_sorted"))
    starts = F.expr(
        "array_sort(transform(filter(_sorted, (x, k) ->"
        " coalesce(x.w = get(_sorted, k - 1).w, false) OR coalesce(x.w = get(_sorted, k + 1).w, false)),"
        " x -> x.i))"
    )
    rows = rows.select(*(c for c in rows.columns if c != "_sorted"), starts.alias("_starts"))
    covered = F.expr(
        f"aggregate(transform(_starts, (s, k) -> least({WINDOW}, coalesce(get(_starts, k + 1) - s, {WINDOW}))),"
        " 0L, (a, x) -> a + x)"
    )
    return rows.select(*(c for c in rows.columns if c != "_starts"), covered.alias("n_repeat_words"))


def _left(pattern: str) -> Column:
    """How many characters of the text are left without the matches."""
    return F.length(F.regexp_replace("_text", pattern, "")).cast("long")


@dataclass(frozen=True)
class Model:
    """The share of good documents, and for each rule how likely it is to say bad, nothing
    and good about good documents (on_good) and about bad ones (on_bad)."""

    good: float
    on_good: tuple[tuple[float, ...], ...]
    on_bad: tuple[tuple[float, ...], ...]

    def weights(self) -> list[list[float]]:
        """What each vote of each rule adds to the log odds of good.

        A rule may be worth nothing, but is never believed to mean the opposite.
        """
        logs = [
            [math.log(g / b) for g, b in zip(*both, strict=True)]
            for both in zip(self.on_good, self.on_bad, strict=True)
        ]
        return [[min(bad, 0.0), none, max(good, 0.0)] for bad, none, good in logs]

    def posterior(self) -> Column:
        score = F.lit(math.log(self.good / (1 - self.good)))
        for i, (bad, none, good) in enumerate(self.weights()):
            v = F.col(f"_v{i}")
            score = score + F.when(v < 0, bad).when(v > 0, good).otherwise(none)
        return 1 / (1 + F.exp(-score))


def fit(voted: DataFrame, rules: int) -> Model:
    """Estimate from the votes (columns _v0, _v1, ...) of all documents."""
    votes = [f"_v{i}" for i in range(rules)]
    patterns = staged(voted.groupBy(*votes).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    model = Model(START_GOOD, (START_ON_GOOD,) * rules, (START_ON_BAD,) * rules)
    said = [F.expr(f"{v} = {k}") for v in votes for k in (-1, 0, 1)]
    for _ in range(ROUNDS):
        weighed = patterns.withColumn("p", model.posterior())
        n, good, *sums = weighed.agg(
            F.sum("n"),
            F.sum(F.col("n") * F.col("p")),
            *(F.sum(F.when(x, F.col("n") * F.col("p")).otherwise(0.0)) for x in said),
            *(F.sum(F.when(x, F.col("n") * (1 - F.col("p"))).otherwise(0.0)) for x in said),
        ).first()
        if not n:
            return model
        shares = []
        for all_of, part in ((good, sums[: 3 * rules]), (n - good, sums[3 * rules :])):
            # Half a document more of each kind: no vote is thought impossible.
            each = [(x + 0.5) / (all_of + 1.5) for x in part]
            shares.append(tuple(tuple(each[3 * i : 3 * i + 3]) for i in range(rules)))
        new = Model((good + 0.5) / (n + 1), *shares)
        flat = lambda m: [m.good, *(x for r in (*m.on_good, *m.on_bad) for x in r)]
        moved = max(abs(x - y) for x, y in zip(flat(new), flat(model), strict=True))
        model = new
        if moved < SETTLED:
            break
    return model


def judge(docs: DataFrame, text_col: str = "text", rules=RULES, keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents with FEATURES, base_failed, posterior and kept.

    The table with its votes is written to the shared folder once, as it is read for the
    estimate and for the verdicts: give it the columns that are needed.
    """
    held, (text,), back = set_apart(docs, text_col)
    rows = with_features(held, text)
    votes = {
        f"_v{i}": F.expr(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END")
        for i, (_, bad, good) in enumerate(rules)
    }
    failed = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words")
    kept = [c for c in rows.columns if not c.startswith("_")]
    voted = rows.withColumns(votes).withColumn("base_failed", failed)
    voted = staged(voted.select(*kept, "base_failed", *votes), "votes")
    model = fit(voted, len(rules))
    judged = voted.withColumn("posterior", model.posterior())
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_from))
    return back(judged, *FEATURES, "base_failed", "posterior", "kept")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are kept, with their own columns."""
    held, (text,), back = set_apart(docs, text_col)
    return back(judge(held, text).where("kept"))
