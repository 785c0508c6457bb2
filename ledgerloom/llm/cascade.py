"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

A rule is a condition under which a document fails. On a bounded sample each rule is timed, and the rows are counted by
the set of rules that they fail; the rules then stand in one CASE expression, always next the one that rejects most of
the rows left per second, so a document is judged by as few and as cheap rules as possible. A rule's time is that of an
aggregate that evaluates it many times per row, the least of a few runs, less that of one that evaluates nothing. The
order changes only the work: a document is kept if no rule fails. The counts are always computed, as they are results.

Nothing is shuffled. Counts are exact, over whole texts; eight-word windows are compared by a 64-bit hash of the
hashes of their words.

Defined results: a null or blank text has no words and fails; repeated rows are judged alike; an empty table gives
an empty table, with the rules in the order given; columns of the input that have a name of a result are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources import work_folder

# Fixed values of the counts.
BLANKS, NOT_BLANK, SYMBOL, WINDOW = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]", "[#*$%&|<>]", 8
# Rows of the sample on which rules are timed, about; it decides the order of the rules only.
SAMPLE_ROWS = 2000
# Times that a rule is evaluated per row when it is timed, and timed runs.
TIMES, RUNS = 20, 3
# Seconds below which costs do not differ.
LEAST_SECONDS = 1e-3
# Scripts that are written without spaces between words.
UNSPACED = r"[\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}\\p{IsLao}\\p{IsKhmer}\\p{IsMyanmar}]"


class Rule(NamedTuple):
    """``fails`` is an expression over the columns of the judged table; null counts as not failing."""

    name: str
    fails: str


# The rules every judgement starts from, over the counts of :func:`text_counts`.
BASE_RULES = (
    Rule("too_short", "n_words < 20"),
    Rule("repeats_itself", "100 * n_repeat_words > 30 * n_words"),
)
# Rules over the counts and the text; generous, so that only junk fails.
RULES = (
    Rule("symbols", "5 * n_symbols > n_words"),
    Rule("duplicate_lines", "n_dup_lines > 3 AND 2 * n_dup_lines > regexp_count(text, '\\n') + 1"),
    Rule(
        "word_length",
        "word_chars < 2 * n_words OR "
        f"(word_chars > 25 * n_words AND 2 * regexp_count(text, '{UNSPACED}') <= word_chars)",
    ),
    Rule("few_letters", r"2 * regexp_count(text, '\\p{L}') < word_chars"),
    Rule("shouting", r"2 * regexp_count(text, '\\p{Lu}') > regexp_count(text, '\\p{L}')"),
)


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long) of the whole text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    results = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    kept = [c for c in docs.columns if c not in results]
    # Each step uses the arrays of the step before several times, so they are computed once per row.
    split = docs.select(
        *kept,
        F.filter(F.split(whole, BLANKS), lambda w: w != "").alias("_words"),
        F.filter(F.split(whole, "\n"), lambda x: x.rlike(NOT_BLANK)).alias("_lines"),
        F.regexp_count(whole, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
    )
    counted = split.select(
        *kept,
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )

    def window(i: Column) -> Column:
        return F.xxhash64(*(F.get("_hashes", i + k) for k in range(WINDOW)))

    starts = F.sequence(F.lit(0), F.size("_hashes") - WINDOW)
    windows = counted.withColumn("_windows", F.when(F.size("_hashes") >= WINDOW, F.transform(starts, window)))
    # Equal windows stand together when sorted; few texts have any.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    by_hash = windows.withColumn(
        "_sorted",
        F.when(repeats, F.array_sort(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))),
    )

    def twice(j: Column) -> Column:
        own = F.get("_sorted", j)["w"]
        return F.coalesce(F.get("_sorted", j - 1)["w"] == own, F.lit(False)) | F.coalesce(
            F.get("_sorted", j + 1)["w"] == own, F.lit(False)
        )

    places = F.transform(
        F.filter(F.sequence(F.lit(0), F.size("_sorted") - 1), twice), lambda j: F.get("_sorted", j)["i"]
    )
    found = by_hash.withColumn("_places", F.when(F.col("_sorted").isNotNull(), F.array_sort(places)))
    # A window covers the words up to the next such window, eight at most.
    covered = F.transform(
        F.col("_places"),
        lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", k + 1) - p, F.lit(WINDOW))),
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(*kept, *results[:-1], F.coalesce(total, F.lit(0)).cast("long").alias(results[-1]))


def failing(rule: Rule) -> Column:
    return F.coalesce(F.expr(rule.fails), F.lit(False))


def rule_seconds(sample: DataFrame, rules: Sequence[Rule]) -> list[float]:
    """Seconds that each rule takes on a written sample, job and scan not counted."""
    again = sample.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(TIMES))))

    def seconds(fails: Column) -> float:
        # An aggregate is not moved below the repetition of rows, as a filter would be.
        job = again.agg(F.count_if(fails))
        runs = []
        for _ in range(RUNS + 1):
            begin = time.perf_counter()
            job.collect()
            runs.append(time.perf_counter() - begin)
        # The first run compiles.
        return min(runs[1:])

    nothing = seconds(F.length("text") < 0)
    return [max(LEAST_SECONDS, seconds(failing(rule)) - nothing) for rule in rules]


def failure_sets(sample: DataFrame, rules: Sequence[Rule]) -> dict[int, int]:
    """Sample rows by the set of rules they fail, as a mask; no more than there are sample rows."""
    mask = sum((F.when(failing(rule), 1 << i).otherwise(0) for i, rule in enumerate(rules)), F.lit(0))
    return {r.mask: r.n for r in sample.groupBy(mask.alias("mask")).agg(F.count(F.lit(1)).alias("n")).collect()}


def greedy_order(sets: dict[int, int], seconds: Sequence[float]) -> list[int]:
    """Rule numbers: always next the one with the most rejections per second among the rows left; ties as given."""
    left, order = dict(sets), []
    while len(order) < len(seconds):
        rest = [i for i in range(len(seconds)) if i not in order]
        best = max(rest, key=lambda i: (sum(n for mask, n in left.items() if mask >> i & 1) / seconds[i], -i))
        order.append(best)
        left = {mask: n for mask, n in left.items() if not mask >> best & 1}
    return order


def cascade_order(sample: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """``rules`` in order of rejections per second on a written sample."""
    return [rules[i] for i in greedy_order(failure_sets(sample, rules), rule_seconds(sample, rules))]


def passes(rules: Sequence[Rule]) -> Column:
    """True if no rule fails; a rule is evaluated only if all before it let the row pass."""
    verdict = F.when(failing(rules[0]), False)
    for rule in rules[1:]:
        verdict = verdict.when(failing(rule), False)
    return verdict.otherwise(True)


def judge_documents(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Add the counts, ``base_failed`` (a base rule fails) and ``kept`` (no rule fails)."""
    docs = docs.drop("base_failed", "kept")
    if text != "text":
        docs = docs.withColumn("text", F.col(text))
    folder = work_folder(docs.sparkSession, "cascade-sample")
    share = min(1.0, sample_rows / max(1, docs.count()))
    text_counts(docs.sample(share, seed=7)).write.parquet(folder)
    order = cascade_order(docs.sparkSession.read.parquet(folder), [*BASE_RULES, *rules])
    return text_counts(docs).withColumns(
        {"base_failed": ~passes(BASE_RULES), "kept": passes(order)}
    )
