"""How the terms of each (lang, source) group differ from its lang and from other sources.

1. Count. Python counts the terms of each batch of texts; Spark sums them per group and
   term. A lang keeps the terms that stand in ``least`` of its documents, and one row
   per kept term lists the sources that have it.
2. Cells. All terms with the same two counts have the same value, so ``f`` is evaluated
   once per cell: (group count, lang count) against the lang, (count here, count there)
   between two sources of a lang. Terms that a source lacks are one cell by subtraction.
3. Rank. Cells of equal value are merged; values are ranked by the cumulative number of
   their terms, and only values that begin within the limit are expanded into terms, in
   UTF-8 order.

With N terms counted and V kept, ``p = 1 + floor(scale * (count + 1) / (N + V))`` in decimals,
``f = floor((p - q)^2 / q)`` in 64 bits; both are exact, and sums beyond 64 bits fail openly.

Between sources, a pair of sources meets in a term only where both have it; the row of a
term holds one entry per source of its lang, as the result itself has a row for each pair
of them.

Defined results: null text, lang and source are empty strings; a group without terms, or
of a lang without kept terms, has its pairs (of value 0 if nothing is kept) and no terms;
repeated rows are documents of their own; ties are ranked by item; texts of any length are
read whole; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.cut import Tables, written

#: Documents of a lang that a kept term needs; what a share of 1 counts.
LEAST, SCALE = 3, 1_000_000_000
#: Ranks of terms per group.
RANKS = 200
#: Entries that a task holds before it passes them on.
HELD = 400_000

COUNTS = ["lang", "source", "term", "n", "docs"]
GROUP = ["lang", "source"]

#: What each UTF-8 byte becomes: letters of ASCII in lower case, its other characters a blank.
_BYTES = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))
#: Bits that the number of documents has beside the number of occurrences.
_BITS = 31


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``COUNTS``, partly summed; a null term counts the documents of its group."""

    def tables(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in held.items():
            both = np.fromiter(counts.values(), np.int64, len(counts))
            group = [pa.array([x], pa.string()).take(pa.array(np.zeros(len(counts), np.int8))) for x in (lang, source)]
            terms = pa.array(counts, pa.binary()).cast(pa.string())
            numbers = pa.array(both >> _BITS), pa.array(both & ((1 << _BITS) - 1))
            yield pa.RecordBatch.from_arrays([*group, terms, *numbers], COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        entries = 0
        for batch in batches:
            for own, *group in zip(*(batch.column(i).to_pylist() for i in range(3))):
                counts = held.setdefault(tuple(group), {})
                before = len(counts)
                counts[None] = counts.get(None, 0) + 1
                for term, n in Counter(own.encode().translate(_BYTES).split(b" ")).items():
                    if term:
                        counts[term] = counts.get(term, 0) + (n << _BITS) + 1
                entries += len(counts) - before
                if entries >= HELD:
                    yield from tables(held)
                    held, entries = {}, 0
        yield from tables(held)

    blank = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))]
    return docs.select(*blank).mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _value(p: str, q: str) -> str:
    """SQL of a cell's value."""
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _p(n: str, total: str, scale: int) -> str:
    """SQL of the share of a count, without rounding."""
    return f"(1 + (cast({n} + 1 AS decimal(19,0)) * cast({scale} AS decimal(11,0))) div cast({total} AS decimal(19,0)))"


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least: int = LEAST,
    ranks: int = RANKS,
    scale: int = SCALE,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: parts ``pair`` (other sources) and ``term``."""
    spark = docs.sparkSession
    with Tables() as early:
        counts = written(term_counts(docs, text, lang, source), "counts")
    # Counts are summed per batch already; both sums need one exchange.
    dealt = counts.where("term IS NOT NULL").repartition("lang", "term")
    terms = dealt.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).groupBy("lang", "term").agg(
        F.collect_list(F.struct("source", "n")).alias("places"), F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    terms = written(terms.where(F.col("docs") >= least).select("lang", "term", "n", F.array_sort("places").alias("places")), "terms")
    every = written(counts.where("term IS NULL").select(*GROUP).distinct(), "every")
    kept = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_n"))
    own = terms.select("lang", "n", F.explode("places").alias("at")).select("lang", "at.source", F.col("at.n").alias("a"), F.col("n").alias("b"))
    # The cells against the lang; their sums by source are what each group has of each count.
    cells = written(own.groupBy(*GROUP, "a", "b").agg(F.count("*").alias("m")), "cells")
    sums = cells.groupBy(*GROUP).agg(F.sum(F.col("a") * F.col("m")).alias("n"), F.sum("m").alias("m"))
    groups = every.join(sums, GROUP, "left").join(kept, "lang", "left").na.fill(0, ["n", "m", "v", "lang_n"])
    groups = written(groups.withColumn("total", F.col("n") + F.col("v")), "groups")
    early.release(spark)
    return _pairs(terms, cells, groups, scale).unionByName(_terms(terms, cells, groups, ranks, scale))


def _terms(terms: DataFrame, cells: DataFrame, groups: DataFrame, ranks: int, scale: int) -> DataFrame:
    """The terms that a group has more often than its lang, up to ``ranks`` of each group."""
    p, q = _p("a", "total", scale), _p("b", "lang_n + v", scale)
    valued = cells.join(groups.select(*GROUP, "total", "lang_n", "v"), GROUP)
    valued = valued.selectExpr(*GROUP, "a", "b", "m", f"{p} p", f"{q} q").where("p > q")
    valued = written(valued.selectExpr(*GROUP, "a", "b", "m", f"{_value('p', 'q')} value"), "values")
    # Each value has a term at least, so the first values hold all ranks asked for.
    falling = Window.partitionBy(*GROUP).orderBy(F.desc("value"))
    merged = valued.groupBy(*GROUP, "value").agg(F.sum("m").alias("m"))
    merged = merged.withColumn("at", F.row_number().over(falling)).where(F.col("at") <= ranks)
    before = F.sum("m").over(falling.rowsBetween(Window.unboundedPreceding, -1))
    merged = merged.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < ranks)
    chosen = valued.join(merged.select(*GROUP, "value", "before"), [*GROUP, "value"])
    chosen = written(chosen.select(*GROUP, "a", "b", "value", "before"), "chosen")
    places = terms.select("lang", "term", F.col("n").alias("b"), F.explode("places").alias("at"))
    places = places.select("lang", "at.source", F.col("at.n").alias("a"), "b", "term")
    found = places.join(chosen, [*GROUP, "a", "b"])
    rank = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "term"))
    return found.withColumn("rank", rank).where(F.col("rank") <= ranks).select(
        *GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"
    )


def _pairs(terms: DataFrame, cells: DataFrame, groups: DataFrame, scale: int) -> DataFrame:
    """Every source against each other source of its lang, over all kept terms."""
    # Sources meet where both have a term; one row of a cell serves both directions.
    # Terms with equal counts everywhere are taken together.
    vectors = terms.where(F.size("places") > 1).groupBy("lang", "places").agg(F.count("*").alias("m"))
    here = vectors.select("lang", "m", "places", F.posexplode("places").alias("i", "x"))
    later = F.slice("places", F.col("i") + 2, F.size("places"))
    meet = here.select("lang", "m", F.col("x.source").alias("s"), F.col("x.n").alias("a"), F.explode(later).alias("y"))
    meet = meet.groupBy("lang", "s", F.col("y.source").alias("t"), "a", F.col("y.n").alias("c")).agg(F.sum("m").alias("m"))
    meet = written(meet, "meetings")
    turned = meet.selectExpr("lang", "t AS s", "s AS t", "c AS a", "a AS c", "m")
    meet = meet.unionByName(turned)
    here = groups.selectExpr("lang", "source AS s", "total AS p_total", "m AS p_m", "v")
    there = groups.selectExpr("lang", "source AS t", "total AS q_total", "m AS q_m")
    # One row per pair, as in the result.
    pairs = written(here.join(there, "lang").where("s <> t"), "pairs")
    p, q = _p("a", "p_total", scale), _p("c", "q_total", scale)
    p0, q0 = _p("0", "p_total", scale), _p("0", "q_total", scale)
    shared = meet.join(pairs, ["lang", "s", "t"]).selectExpr("lang", "s", "t", "m", f"{p} p", f"{q} q", f"{p0} p0", f"{q0} q0")
    shared = shared.selectExpr(
        "lang", "s", "t",
        f"m * ({_value('p', 'q')} - {_value('p', 'q0')} - {_value('p0', 'q')} + {_value('p0', 'q0')}) value",
    )
    used = pairs.where("v > 0")
    by_count = cells.groupBy(*GROUP, "a").agg(F.sum("m").alias("m"))
    one = by_count.selectExpr("lang", "source AS s", "a", "m").join(used.drop("m"), ["lang", "s"])
    one = one.selectExpr("lang", "s", "t", "m", f"{p} p", f"{q0} q0").selectExpr("lang", "s", "t", f"m * {_value('p', 'q0')} value")
    other = by_count.selectExpr("lang", "source AS t", "a AS c", "m").join(used.drop("m"), ["lang", "t"])
    other = other.selectExpr("lang", "s", "t", "m", f"{p0} p0", f"{q} q").selectExpr("lang", "s", "t", f"m * {_value('p0', 'q')} value")
    none = used.selectExpr("lang", "s", "t", "v - p_m - q_m AS m", f"{p0} p0", f"{q0} q0")
    none = none.selectExpr("lang", "s", "t", f"m * {_value('p0', 'q0')} value")
    empty = pairs.where("v = 0").selectExpr("lang", "s", "t", "0L value")
    summed = shared.unionByName(one).unionByName(other).unionByName(none).unionByName(empty)
    summed = summed.groupBy("lang", "s", "t").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "s").orderBy(F.desc("value"), "t"))
    return summed.select("lang", F.col("s").alias("source"), F.lit("pair").alias("part"), F.col("t").alias("item"), "value", rank.alias("rank"))
