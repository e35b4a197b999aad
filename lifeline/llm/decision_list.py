"""Quality rules: a learned decision list, emitted as a Spark expression.

Statistics of a text are computed by built-in functions.  From the statistics
of labelled documents, sequential covering learns threshold conjunctions for
low quality: a rule is grown condition by condition on two thirds of the rows
(by FOIL gain), pruned on the rest, and kept while it is precise there; then
the rows that it covers are set aside.  The ordered list becomes one
``CASE WHEN`` expression.

Learning reads about ``TRAIN_ROWS`` labelled documents (at most twice as many),
those with the smallest hash of doc_id, and runs on their statistics alone; statistics and
verdicts cover every row.

Defined results: a null or empty text has no words and fails the base rule;
labels that are null or of unknown documents are not used; with no usable
labels the list is empty and the base rule alone decides; rows are judged one
by one, whatever their doc_id; other columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeline.llm.tables import hashed_sample

#: Fixed values of the base rule: fewest words, and the percentage of words in repeated windows.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

TRAIN_ROWS = 20_000
THRESHOLDS = 32
MAX_CONDITIONS = 4
MAX_RULES = 12
MIN_PRECISION = 0.95
MIN_COVERED = 5
#: Rows of neither kind that pruning adds to those a rule covers.
DOUBT = 20
#: Rules that are tried for each that may be taken.
TRIES = 2

_SEPARATORS = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are hashed; (hash, position) pairs packed into one number are
    sorted, so equal windows become neighbours.  Each repeated window then
    adds the words that the repeated window before it doesn't cover."""

    def count(h: Column) -> Column:
        n = F.size(h).cast("long")
        room = F.expr("4611686018427387904L") / n  # 2^62
        packed = F.transform(h, lambda x, k: F.pmod(x, F.floor(room)) * n + k)

        def neighbours(s: Column) -> Column:
            at = lambda k: F.get(h, (F.get(s, k) % n).cast("int"))
            twice = F.transform(
                s, lambda x, k: F.when((at(k) == at(k - 1)) | (at(k) == at(k + 1)), x % n)
            )
            found = F.sort_array(F.filter(twice, lambda x: x.isNotNull()))
            return let(
                found,
                lambda r: F.aggregate(
                    F.transform(r, lambda x, k: F.when(k == 0, F.lit(3).cast("long")).otherwise(F.least(F.lit(3).cast("long"), x - F.get(r, k - 1)))),
                    F.lit(0).cast("long"),
                    lambda a, x: a + x,
                ),
            )

        return F.when(n < 2, F.lit(0).cast("long")).otherwise(let(F.sort_array(packed), neighbours))

    hashes = F.when(
        F.size(words) >= 3,
        F.transform(F.sequence(F.lit(1), F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1))),
    )
    return F.coalesce(let(hashes, count), F.lit(0).cast("long"))


def text_stats(text: Column) -> Column:
    """The statistics of a text as a struct of longs."""
    text = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(text, F.lit(_BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SEPARATORS))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    of_words = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeated_words(w).alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        lines,
        lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")),
    )
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    return F.struct(
        of_words.alias("words"),
        of_lines.alias("lines"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        count(r"[A-Z]").alias("n_upper"),
        count(r"[0-9]").alias("n_digits"),
        count(r"[!?]").alias("n_bangs"),
    )


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_bangs")

#: Shares that the rules may use; a share of nothing is 0.
FEATURES = {
    "mean_word": ("word_chars", "n_words"),
    "symbols": ("n_symbols", "word_chars"),
    "upper": ("n_upper", "word_chars"),
    "digits": ("n_digits", "word_chars"),
    "bangs": ("n_bangs", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}


def with_stats(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the statistics."""
    s = docs.select(*keep, text_stats(F.col("text")).alias("__s"))
    place = {"n_words": "words.", "word_chars": "words.", "n_repeat_words": "words.", "n_lines": "lines.", "n_dup_lines": "lines."}
    return s.select(*keep, *(F.col(f"__s.{place.get(c, '')}{c}").alias(c) for c in STATS))


def feature(name: str) -> Column:
    part, whole = FEATURES[name]
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, row: dict[str, float]) -> bool:
        return (row[self.feature] >= self.threshold) == self.at_least

    def column(self) -> Column:
        c = feature(self.feature) >= F.lit(self.threshold)
        return c if self.at_least else ~c

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, rows: list) -> list:
    return [r for r in rows if all(c.holds(r[0]) for c in rule)]


def _count(rows: list) -> tuple[int, int]:
    bad = sum(r[1] for r in rows)
    return bad, len(rows) - bad


def _grow(rows: list, grid: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS:
        bad, good = _count(rows)
        if not good or not bad:
            break
        before, best, found = math.log2(bad / (bad + good)), 0.0, None
        for name, steps in grid.items():
            by_step = [[0, 0] for _ in range(len(steps) + 1)]
            for values, is_bad in rows:
                by_step[bisect_right(steps, values[name])][is_bad] += 1
            below = [0, 0]
            for k, threshold in enumerate(steps):
                below = [a + b for a, b in zip(below, by_step[k], strict=True)]
                for at_least, (g, b) in ((False, below), (True, (good - below[0], bad - below[1]))):
                    gain = b * (math.log2(b / (b + g)) - before) if b else 0.0
                    if gain > best + 1e-9:
                        best, found = gain, Condition(name, at_least, threshold)
        if found is None:
            break
        rule, rows = (*rule, found), _covered((found,), rows)
    return rule


def _prune(rule: Rule, rows: list) -> Rule:
    """The rule without the conditions that don't earn their place: the one
    whose loss hurts the balance of bad over good rows least goes, while none is
    lost by it.  A rule that covers few rows counts for less than its balance says."""

    def worth(r: Rule) -> float:
        bad, good = _count(_covered(r, rows))
        return (bad - good) / (bad + good + DOUBT)

    while len(rule) > 1:
        best = max((rule[:k] + rule[k + 1 :] for k in range(len(rule))), key=worth)
        if worth(best) < worth(rule):
            break
        rule = best
    return rule


def learn(rows: list[tuple[dict[str, float], int]]) -> list[Rule]:
    """Ordered rules for rows labelled 1 (low quality) or 0."""
    grid = {}
    for name in FEATURES:
        values = sorted(r[0][name] for r in rows)
        grid[name] = sorted({values[len(values) * k // THRESHOLDS] for k in range(1, THRESHOLDS)}) if values else []
    grow, prune = [r for k, r in enumerate(rows) if k % 3], rows[::3]
    rules: list[Rule] = []
    for _ in range(TRIES * MAX_RULES):
        rule = _grow(grow, grid) if len(rules) < MAX_RULES else ()
        if not rule:
            break
        rule = _prune(rule, prune)
        bad, good = _count(_covered(rule, prune))
        # a weak rule is not taken, but its rows don't hide the next one
        grow = [r for r in grow if not all(c.holds(r[0]) for c in rule)]
        if bad >= MIN_COVERED and bad >= MIN_PRECISION * (bad + good):
            rules.append(rule)
            prune = [r for r in prune if not all(c.holds(r[0]) for c in rule)]
    return rules


def passes(rules: list[Rule]) -> Column:
    """The ordered list as one conditional expression: true if no rule fires."""
    out = None
    for rule in rules:
        fires = rule[0].column()
        for c in rule[1:]:
            fires = fires & c.column()
        out = F.when(fires, F.lit(False)) if out is None else out.when(fires, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> list[Rule]:
    """Learn from the labelled documents with the smallest hashes."""
    sample = hashed_sample(
        labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), "quality"),
        train_rows,
        "doc_id",
    )
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    # a filter on the statistics would move below the join and compute them for every document
    rows = (
        with_stats(picked, "doc_id", "quality")
        .select(
            F.xxhash64("doc_id").alias("h"), "doc_id", "quality", base_failed().alias("failed"), *(feature(f).alias(f) for f in FEATURES)
        )
        .orderBy("h", "doc_id", "quality", *FEATURES)
        .limit(2 * train_rows)
        .collect()
    )
    return learn([({f: r[f] for f in FEATURES}, 1 - r["quality"]) for r in rows if not r["failed"]])


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, statistics, base_failed, kept) for every row."""
    out = with_stats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & passes(rules))


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` without rejected rows, same columns."""
    s = with_stats(docs.select(F.struct(*docs.columns).alias("__row"), "text"), "__row")
    return s.where(~base_failed() & passes(rules)).select("__row.*")
