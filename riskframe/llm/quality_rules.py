"""Document quality rules as a short-circuit cascade of SQL expressions.

A document stays if no rule rejects it. On a bounded sample every rule is timed and its share of
rejections counted; rules then stand in order of rejections per second, so most bad documents
meet the rule that costs least for what it rejects, and the rules behind it are not evaluated
for them. The order changes cost only: the verdict is the same in any order.

The whole operator is built-in Spark SQL functions. Repeated three-word windows are found inside
the row: windows are sorted by hash and words, so equal ones become neighbours, and the positions
they cover are merged; no window leaves its row, so there is no shuffle.

Defined cases: a missing text has no words and fails the base rules; further columns play no
part; repeated rows get a verdict each; an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import SPACES, content, packed

SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 400
SAMPLE_CHARS = 50_000

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 20
MAX_DUP_LINES_PERCENT = 30
#: Fewer repeated lines than this spare a text, so short ones with a refrain stay.
MIN_DUP_LINES = 3
MAX_SHOUT_PERCENT = 60
MAX_WORD_CHARS = 20
MAX_MARKED_WORDS_PERCENT = 30


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for documents to drop; it may read ``content`` and the measures."""

    name: str
    rejects: Column


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")


def _repeat_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more, the first occurrence included."""
    last = F.size(w) - 2
    windows = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.struct(
            F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)).alias("h"),
            F.get(w, i - 1).alias("a"),
            F.get(w, i).alias("b"),
            F.get(w, i + 1).alias("c"),
            i.alias("at"),
        ),
    )
    ordered = F.array_sort(windows)

    def equal(x: Column, y: Column) -> Column:
        return (x.h == y.h) & (x.a == y.a) & (x.b == y.b) & (x.c == y.c)

    def repeated(s: Column) -> Column:
        return F.array_sort(
            F.transform(
                F.filter(
                    s,
                    lambda x, k: F.coalesce(equal(x, F.get(s, k - 1)), F.lit(False))
                    | F.coalesce(equal(x, F.get(s, k + 1)), F.lit(False)),
                ),
                lambda x: x.at,
            )
        )

    def covered(p: Column) -> Column:
        # Ascending starts: each adds the words up to the next start, three at most.
        return F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.get(p, k + 1) - x)),
            F.lit(0).cast("long"),
            lambda total, step: total + step,
        )

    return F.when(last < 2, F.lit(0).cast("long")).otherwise(
        _bind(ordered, lambda s: _bind(repeated(s), covered))
    )


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _has_word(line: Column) -> Column:
    return F.length(F.translate(line, SPACES, "")) > 0


def measures(text: Column) -> dict[str, Column]:
    """The base measures of a text."""
    lines = F.filter(F.split(text, "\n"), _has_word)
    return {
        "n_words": F.size(words(text)).cast("long"),
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _bind(words(text), _repeat_words),
    }


def base_rules() -> tuple[Rule, ...]:
    repeated = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return (
        Rule("few_words", F.col("n_words") < MIN_WORDS),
        Rule("repeated_windows", repeated),
    )


def default_rules() -> tuple[Rule, ...]:
    text = F.col("content")
    upper = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    lines = F.size(F.filter(F.split(text, "\n"), _has_word))
    repeated = F.col("n_dup_lines")
    marked = F.regexp_count(text, F.lit(r"([!|#*$%&]+(?=[ \n]|$))"))
    return (
        Rule("symbols", 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars")),
        # Shares count lines that hold a word: blank lines between lines hide nothing.
        Rule(
            "duplicate_lines",
            (repeated >= MIN_DUP_LINES) & (100 * repeated > MAX_DUP_LINES_PERCENT * lines),
        ),
        Rule("shouting", 100 * upper > MAX_SHOUT_PERCENT * F.col("word_chars")),
        Rule("long_words", F.col("word_chars") > MAX_WORD_CHARS * F.col("n_words")),
        Rule("marked_words", 100 * marked > MAX_MARKED_WORDS_PERCENT * F.col("n_words")),
    )


def _sample(docs: DataFrame, text: str, rows: int, chars: int) -> DataFrame:
    """At most ``rows`` texts of at most ``chars`` characters; it decides the order of rules only."""
    found = (
        packed(docs)
        .select(content(text).alias("content"))
        .where(F.length("content") <= chars)
        .take(rows)
    )
    return docs.sparkSession.createDataFrame(found, "content string").coalesce(1)


def estimate(sample: DataFrame, rules: Sequence[Rule], repeats: int = 2) -> list[Estimate]:
    """Seconds and share of rejections of every rule over a sample with ``content``.

    The time of a job that reads the sample and tests nothing is taken off.
    """
    inputs = measures(F.col("content"))

    def timed(verdict: Column) -> tuple[float, float]:
        job = sample.select("content", *[c.alias(n) for n, c in inputs.items()]).agg(
            F.coalesce(F.avg(verdict.cast("double")), F.lit(0.0))
        )
        best, share = float("inf"), 0.0
        for _ in range(repeats):
            started = time.perf_counter()
            share = job.first()[0]
            best = min(best, time.perf_counter() - started)
        return best, share

    idle, _ = timed(F.length("content") < 0)
    found = []
    for rule in rules:
        seconds, share = timed(F.coalesce(rule.rejects, F.lit(False)))
        found.append(Estimate(rule.name, max(seconds - idle, 1e-4), share))
    return found


def ordered_rules(
    docs: DataFrame,
    rules: Sequence[Rule],
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    sample_chars: int = SAMPLE_CHARS,
) -> list[Rule]:
    """The rules by falling rejections per second, by name where equal."""
    by_name = {rule.name: rule for rule in rules}
    estimates = estimate(_sample(docs, text, sample_rows, sample_chars), rules)
    return [by_name[e.name] for e in sorted(estimates, key=lambda e: (-e.gain, e.name))]


def cascade(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, else null; later branches are not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects, F.lit(rule.name)).otherwise(verdict)
    return verdict


def apply_rules(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    rules: Sequence[Rule] | None = None,
    order: Sequence[Rule] | None = None,
) -> DataFrame:
    """Measures, base verdict, final verdict and the first rejecting rule of every document."""
    own = default_rules() if rules is None else rules
    chain = ordered_rules(docs, own, text) if order is None else order
    base = cascade(base_rules())
    measured = packed(docs).select(
        F.col(f"row.`{key}`").alias("doc_id"), content(text).alias("content")
    ).select("doc_id", "content", *[c.alias(n) for n, c in measures(F.col("content")).items()])
    judged = measured.withColumn("base_rule", base).withColumn(
        "rule",
        F.when(F.col("base_rule").isNotNull(), F.col("base_rule")).otherwise(cascade(chain)),
    )
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.col("base_rule").isNotNull().alias("base_failed"),
        F.col("rule").isNull().alias("kept"),
        "rule",
    )
