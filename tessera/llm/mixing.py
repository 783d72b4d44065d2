"""Mixing sources to target weights along a time-varying curriculum.

Targets: every source gets a share of all words by its weight, at most ``REPEATS``
times its own words; what is above is shared again by weight. Each source's
weight changes linearly during training. The integral of that schedule is the
source's cumulative demand; inverting it at the words that stand before a
document (in a hashed order of its source) gives the document's training
position. The mix is the documents sorted by position in ranges.

Prefix sums never gather a source in one task: a source is dealt over 65,536
hashed buckets, the buckets' totals are summed up, then each bucket's rows.

Defined results: a null text has no words; documents without words are never
taken; a null source is a source of its own, last in order; repeated rows count
as documents of their own; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import words
from tessera.plans.cut import written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
#: Weight at the start and the end of training, relative to the mean, per weight.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
#: A source's words are taken at most so many times.
REPEATS = 3
BUCKET_BITS = 16


def ranked(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``rank`` from 0 in the order of ``column``, nulls last, by range partitions."""
    order = F.col(column).asc_nulls_last()
    held = written(
        rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("part", F.spark_partition_id()),
        "ranked",
    )
    # One row per range partition.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = held.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(W.partitionBy("part").orderBy(order)) - 1
    return held.join(F.broadcast(parts), "part").withColumn("rank", F.col("first") + place).drop("part", "first")


def targets(sources: DataFrame) -> DataFrame:
    """``source, source_size`` with ``class`` (place of the weight) and ``target``.

    Water filling: a target is the level times the weight, or the cap. Each round
    caps what is above the level; the driver sees two sums a round.
    """
    which = (F.col("rank") % len(WEIGHTS)).cast("int")
    rows = ranked(sources, "source").withColumn("class", which)
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("class") + 1))
    rows = written(rows.withColumn("cap", REPEATS * F.col("source_size")), "sources")
    level, capped = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * level > F.col("cap")
        sums = rows.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("cap"))).alias("capped"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
            F.count_if(full).alias("n"),
        ).first()
        if not sums["weight"] or sums["n"] == capped:
            break
        level, capped = (sums["all"] - (sums["capped"] or 0)) / sums["weight"], sums["n"]
    target = F.least(F.col("cap").cast("double"), F.col("weight") * (level or 0.0))
    return rows.select("source", "source_size", "class", target.alias("target"))


def position(demand: Column, target: Column, start: Column, end: Column) -> Column:
    """The time in 0..1 by which a source's schedule has asked for ``demand`` words.

    Inverts ``target * (start * t + (end - start) * t * t / 2)``.
    """
    u = demand / target
    root = F.sqrt(F.greatest(F.lit(0.0), start * start + 2 * (end - start) * u))
    return F.least(F.lit(1.0), 2 * u / (start + root))


def demanded(docs: DataFrame, columns: list[str] | None = None, source: str = "source", text: str = "text") -> DataFrame:
    """Each document with its source's figures and the words before it in its source.

    ``doc`` (a struct of ``columns``, by default all), ``key`` (a hash of the row),
    ``size, source_size, target, class, before``.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("doc")
    key = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        carried,
        F.col(f"`{source}`").alias("source"),
        # A join key without nulls.
        F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`")), F.lit("")).alias("src"),
        F.size(words(F.col(f"`{text}`"))).cast("long").alias("size"),
        key.alias("key"),
        F.shiftrightunsigned(key, 64 - BUCKET_BITS).alias("bucket"),
    )
    buckets = written(rows.groupBy("source", "src", "bucket").agg(F.sum("size").alias("size")), "buckets")
    goals = targets(buckets.groupBy("source").agg(F.sum("size").alias("source_size")))
    goals = goals.withColumn("src", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).drop("source")
    # At most 65,536 rows for each source.
    before = W.partitionBy("src").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    firsts = buckets.select("src", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    firsts = firsts.join(goals, "src")
    inside = W.partitionBy("src", "bucket").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    return rows.join(firsts, ["src", "bucket"]).select(
        "doc",
        "key",
        "size",
        "source_size",
        "target",
        "class",
        (F.col("first") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("before"),
    )


def _position(demand: Column) -> Column:
    ends = [F.element_at(F.array(*[F.lit(s[i]) for s in SCHEDULES]), F.col("class") + 1) for i in (0, 1)]
    return position(demand, F.col("target"), *ends)


def mix(docs: DataFrame, columns: list[str] | None = None, source: str = "source", text: str = "text") -> DataFrame:
    """Every document with the words that the mix takes of it, in training order.

    ``doc, size, source_size, target, taken, position``. The demand of a source
    runs over its documents again and again, so that all its taken words are its
    target rounded; the position is that of the first copy, null if none is taken.
    """
    rows = demanded(docs, columns, source, text)
    goal = F.round("target").cast("long")
    taken = sum(
        F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), goal - e * F.col("source_size") - F.col("before")))
        for e in range(REPEATS)
    )
    rows = rows.withColumn("taken", taken)
    rows = rows.withColumn("position", F.when(F.col("taken") > 0, _position(F.col("before"))))
    # The key deals equal positions, and the many rows without one, over several ranges.
    return rows.orderBy(F.col("position").asc_nulls_last(), "key").select(
        "doc", "size", "source_size", "target", "taken", "position"
    )


def mixed_copies(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """The documents of the mix, whole, once for each copy taken, sorted by position.

    A copy is taken where at least half of it is within the source's target.
    """
    rows = demanded(docs, None, source, text)
    copy = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))))
    demand = F.col("epoch") * F.col("source_size") + F.col("before")
    taken = copy.where((F.col("size") > 0) & (demand + F.col("size") / 2 <= F.col("target")))
    return taken.withColumn("position", _position(demand)).orderBy("position", "key").select("doc.*")
