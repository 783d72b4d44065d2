"""Quality rules as a short-circuit cascade (columns only, no Python on executors).

Every rule is a column that is true where a document is to be rejected. The cost
and the rejections of each rule are measured on a bounded sample; the cascade
asks the rules by rejections per cost and stops at the first that rejects. The
order changes the work, never the verdict.

Defined results: a null text counts as empty and has no words; repeated rows get
the same result each; an empty table gives an empty table; all columns of the
input travel in the struct ``doc``, so that no name can clash.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import NOT_BLANK, let, words
from tessera.plans.cut import written

#: Words of a window when repeated passages are counted.
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
#: Rows of the sample that the order of the rules is estimated on, the code points of
#: its longest text, and how often a rule reads the sample when it is timed.
SAMPLE_ROWS, SAMPLE_CHARS, READS = 256, 1 << 14, 16


@dataclass(frozen=True)
class Rule:
    """A name and a function of (text, words) that gives the rejecting column."""

    name: str
    rejects: Callable[[Column, Column], Column]


def n_words(w: Column) -> Column:
    return F.size(w).cast("long")


def word_chars(w: Column) -> Column:
    """Code points in words."""
    return F.length(F.array_join(w, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS)).cast("long")


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_BLANK))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(w: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that the text holds twice or more.

    One row's work: windows are 64-bit hashes of word hashes, sorted with their
    places only where the text has equal ones at all.
    """

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            again = F.filter(
                s,
                lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)),
            )
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        return F.aggregate(
            let(placed, places),
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"],
        )

    def count(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
        return let(
            windows, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(covered(g))
        )

    found = F.when(F.size(w) <= WINDOW, 0).otherwise(let(F.transform(w, lambda x: F.xxhash64(x)), count))
    return found.cast("long")


def base_rejects(n: Column, repeats: Column) -> Column:
    """Too few words, or more than 30 in 100 in repeated windows."""
    return (n < 20) | (100 * repeats > 30 * n)


#: The production rules. Thresholds are shares of the words or of their characters.
RULES = [
    Rule("few_words", lambda t, w: F.size(w) < 20),
    Rule("symbols", lambda t, w: 10 * n_symbols(t) > 3 * F.size(w)),
    Rule("exclamation", lambda t, w: 2 * F.regexp_count(t, F.lit("!")) > F.size(w)),
    Rule("long_words", lambda t, w: word_chars(w) > 25 * F.size(w)),
    Rule("short_words", lambda t, w: 2 * word_chars(w) < 3 * F.size(w)),
    Rule("dup_lines", lambda t, w: let(_lines(t), lambda x: 10 * F.size(F.array_distinct(x)) < 3 * F.size(x))),
    Rule("repeats", lambda t, w: 100 * n_repeat_words(w) > 30 * F.size(w)),
]


def _prepared(docs: DataFrame, text: str) -> DataFrame:
    """``doc`` (the whole row), ``text`` without nulls and its words."""
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return rows.withColumn("w", words(F.col("text")))


def estimate(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> list[Rule]:
    """The rules by rejections per second, both measured on the first ``SAMPLE_ROWS`` texts
    of at most ``SAMPLE_CHARS`` code points.

    The driver takes them from the first partitions that have enough (17 MB at most) and
    writes them as a small table for the timed jobs, so that no task gathers rows of all
    partitions. What a
    job without a rule takes is not counted. Rules without a rejection in the sample come
    last, the cheaper first; without a sample the rules keep their order.
    """
    held = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    texts = [r["text"] for r in held.where(F.length("text") <= SAMPLE_CHARS).limit(SAMPLE_ROWS).collect()]
    if not texts:
        return list(rules)
    reads = docs.sparkSession.range(0, READS, 1, READS)
    rows = _prepared(written(reads.select(F.explode(F.lit(texts)).alias("text")), "rules-sample"), "text")
    counted = [F.count_if(r.rejects(F.col("text"), F.col("w"))).alias(r.name) for r in rules]
    rejected = rows.agg(*counted).first().asDict()

    def seconds(column: Column) -> float:
        taken = []
        # The first run also compiles.
        for _ in range(2):
            start = time.perf_counter()
            rows.agg(column).first()
            taken.append(time.perf_counter() - start)
        return min(taken)

    idle = seconds(F.count(F.lit(1)))
    cost = {r.name: max(seconds(column) - idle, 1e-4) for r, column in zip(rules, counted)}
    return sorted(rules, key=lambda r: (-rejected[r.name] / cost[r.name], cost[r.name]))


def cascade(rules: list[Rule], text: Column, w: Column) -> Column:
    """The first rule that rejects, or null; later rules are not computed then."""
    first = F
    for rule in rules:
        first = first.when(F.coalesce(rule.rejects(text, w), F.lit(False)), F.lit(rule.name))
    return first


def judge(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """One row per document: ``doc`` and ``rejected_by`` (null where it is kept)."""
    order = estimate(docs, rules or RULES, text)
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # The words are bound inside the expression, so that a filter on it computes them once.
    verdict = let(words(F.col("text")), lambda w: cascade(order, F.col("text"), w))
    return rows.select("doc", verdict.alias("rejected_by"))


def measure(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """``judge`` with the counts that the base verdict rests on.

    ``kept`` is false where the base verdict rejects, and the cascade's verdict
    elsewhere; the cascade is not asked where the base verdict has rejected.
    """
    order = estimate(docs, rules or RULES, text)
    counted = _prepared(docs, text).select(
        "doc",
        "text",
        "w",
        n_words(F.col("w")).alias("n_words"),
        word_chars(F.col("w")).alias("word_chars"),
        n_symbols(F.col("text")).alias("n_symbols"),
        n_dup_lines(F.col("text")).alias("n_dup_lines"),
        n_repeat_words(F.col("w")).alias("n_repeat_words"),
    )
    failed = base_rejects(F.col("n_words"), F.col("n_repeat_words"))
    # The base verdict has asked these two already.
    rest = [r for r in order if r.name not in ("few_words", "repeats")]
    kept = F.when(failed, False).otherwise(cascade(rest, F.col("text"), F.col("w")).isNull())
    return counted.select(
        "doc",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        kept.alias("kept"),
    )


def keep_good(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with their columns."""
    return judge(docs, rules, text).where(F.col("rejected_by").isNull()).select("doc.*")
