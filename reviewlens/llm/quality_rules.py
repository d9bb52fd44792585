"""Quality rules as a short-circuit cascade.

Each rule is a rejection test with its own cost. On a bounded sample every rule
is timed and its share of rejections taken; the rules are then asked in the
order of rejection per cost, and a document leaves at the first rule that
rejects it, so later rules are never worked out for it. The verdict does not
depend on the order, only the work and the name of the rejecting rule do.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import text_or_empty, words_of
from reviewlens.session import store

SAMPLE_ROWS = 2_000  # bound of the sample on which rules are timed

# Fixed values of the base statistics.
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
WINDOW_WORDS = 3
NO_LETTER = r"[^\p{L}\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a condition over the text and its statistics."""

    name: str
    rejects: Callable[[], Column]


BASE_RULES = (
    Rule("few_words", lambda: F.col("n_words") < MIN_WORDS),
    Rule(
        "repeated_windows",
        lambda: 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"),
    ),
)
METHOD_RULES = (
    Rule("symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule(
        "word_length",
        lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
    ),
    Rule("duplicate_lines", lambda: 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
    Rule("few_letters", lambda: 2 * F.regexp_count("text", F.lit(NO_LETTER)) > F.col("word_chars")),
    Rule("capitals", lambda: 2 * F.regexp_count("text", F.lit(r"\p{Lu}")) > F.col("word_chars")),
)


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and the statistics the rules ask for, one row per input row.

    ``n_repeat_words`` counts the words inside three-word windows that occur at
    least twice in the same text. The windows of a text are sorted with their
    positions, equal neighbours marked, and the marked positions merged.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    split = texts.select(
        "doc_id", "text",
        words_of(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    n, last = F.size("words"), F.size("words") - WINDOW_WORDS + 1
    parts = [F.slice("words", F.lit(i + 1), last).alias(f"w{i}") for i in range(WINDOW_WORDS)]
    windows = F.when(
        last > 1, F.sort_array(F.arrays_zip(*parts, F.sequence(F.lit(0), last - 1).alias("at")))
    )
    sorted_windows = split.select(
        "doc_id", "text",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )

    def same(a: Column, b: Column) -> Column:
        return (a["w2"] == b["w2"]) & (a["w1"] == b["w1"]) & (a["w0"] == b["w0"])

    neighbours = F.zip_with(
        F.slice("windows", F.lit(1), F.size("windows") - 1),
        F.slice("windows", F.lit(2), F.size("windows") - 1),
        lambda a, b: F.when(same(a, b), F.array(a["at"], b["at"])),
    )
    marked = sorted_windows.select(
        "*",
        F.sort_array(F.array_distinct(F.flatten(F.filter(neighbours, lambda x: x.isNotNull())))).alias("at"),
    )
    covered = F.aggregate(
        F.zip_with(
            F.slice("at", F.lit(1), F.size("at") - 1), F.slice("at", F.lit(2), F.size("at") - 1),
            lambda a, b: F.least(b - a, F.lit(WINDOW_WORDS)),
        ),
        F.lit(0), lambda total, step: total + step,
    )
    return marked.select(
        "doc_id", "text", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.when(F.size("at") > 0, covered + WINDOW_WORDS).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def order_rules(
    statistics: DataFrame, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS
) -> list[tuple[Rule, float, float]]:
    """The rules by falling rejection per cost, each with (share rejected, seconds).

    The sample is at most about ``sample_rows`` rows, picked by a hash of the
    id; each rule runs over it alone, and the time of an empty pass is taken
    off. An empty table leaves the given order.
    """
    total = statistics.select("doc_id").count()
    step = max(1, -(-total // sample_rows))
    sample = store(
        statistics.filter(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).repartition(1), "rule-sample"
    )

    def timed(condition: Column) -> tuple[float, float]:
        best, share = float("inf"), 0.0
        for _ in range(2):
            start = time.perf_counter()
            share = sample.agg(F.avg(F.coalesce(condition, F.lit(False)).cast("double"))).first()[0] or 0.0
            best = min(best, time.perf_counter() - start)
        return share, best

    idle = timed(F.length("text") < 0)[1]
    measured = []
    for rule in rules:
        share, seconds = timed(rule.rejects())
        measured.append((rule, share, max(seconds - idle, 1e-4)))
    return sorted(measured, key=lambda m: -m[1] / m[2])


def cascade(statistics: DataFrame, ordered: list[Rule]) -> DataFrame:
    """Add ``rejected_by``: the first rule in the given order that rejects, or null."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        verdict = F.when(F.coalesce(rule.rejects(), F.lit(False)), F.lit(rule.name)).otherwise(verdict)
    return statistics.withColumn("rejected_by", verdict)


def judge_quality(
    docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + METHOD_RULES,
    id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Statistics of every document, ``rejected_by`` and ``kept``.

    A null or empty text has no words and is rejected as too short. Repeated
    rows and null ids are judged row by row. Other columns of ``docs`` are not
    looked at, whatever their names. An empty table gives an empty result.
    """
    statistics = text_statistics(docs, id_col, text_col)
    ordered = [rule for rule, _, _ in order_rules(statistics, rules, sample_rows)]
    return cascade(statistics, ordered).withColumn("kept", F.col("rejected_by").isNull())
