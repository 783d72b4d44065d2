"""Licence scans by diagonal voting (columns and joins only).

All rolling word k-grams of a document meet the template positions of equal
hash in a join; templates of many words have longer grams. Hits of one template at
one offset (document position minus template position) form a diagonal; the template
words that they show, as bits of as many longs as the longest template needs, are its
votes. Diagonals that show all words are exact places. Elsewhere neighbouring
diagonals form a chain (words may be missing or added); each diagonal alone, with
any of its neighbours and the chain as a whole are verified, and the best counts if
enough of the template stands in it and little else does. One pass over the texts
makes the diagonals, with one row more per text for its number of words.

Defined results: null and empty texts have no words and no label; a document
shorter than a gram has none; repeated rows get the same result each (votes are
bits, so a repeat cannot vote twice); an empty table gives an empty table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import let, lower_words, text_key
from tessera.plans.cut import written

#: What stands between words: ASCII characters that are neither digits nor letters.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words of a gram; the shortest phrase has as many.
K = 2
#: Words of a gram of templates with at least LONG words: two short grams on end.
LONG_K, LONG = 2 * K, 48
#: Diagonals at most so far apart belong to one span, and at most this share of the template's words.
NEAR, NEAR_SHARE = 3, 1 / 16
#: Bits of a long: words of a template per column of votes.
BITS = 64
#: The template of the row that holds a text's number of words.
WORDS = -1
#: Rows made at once from the count of equal input rows.
COPIES = 1 << 16
#: Least share of the template's words in a span, and of a span's words in the template.
COVERED, DENSE = 0.75, 0.75


@dataclass(frozen=True)
class Template:
    """A phrase and its label; ``exact`` ones count only where they stand whole."""

    text: str
    label: str
    exact: bool = False

    @cached_property
    def size(self) -> int:
        return sum(w != "" for w in re.split(GAP, self.text))

    @property
    def k(self) -> int:
        return K if self.size < LONG else LONG_K


# The base phrases with their labels.
BASE = [
    Template("gnu general public license", "gpl", True),
    Template("apache license", "apache", True),
    Template("cc by", "cc-by", True),
    Template("mit license", "mit", True),
]
#: Phrases of common licences, by which the method adds labels of its own.
PHRASES = [
    Template("licensed under the gnu general public license version 3", "gpl-3.0"),
    Template("licensed under the gnu general public license version 2", "gpl-2.0"),
    Template("gnu lesser general public license", "lgpl"),
    Template("licensed under the apache license version 2 0", "apache-2.0"),
    Template("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    Template("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    Template("released under the mit license", "mit-notice"),
    Template(
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "mit-grant",
    ),
    Template(
        "redistribution and use in source and binary forms with or without modification are permitted",
        "bsd",
    ),
    Template("subject to the terms of the mozilla public license", "mpl"),
]


# The words of whole licences.
TEXTS = [
    Template(
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
        "mit-text",
    ),
    Template(
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
        IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
        "isc-text",
    ),
    Template(
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
        "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
        CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
        (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
        BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
        TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
        THE POSSIBILITY OF SUCH DAMAGE.""",
        "bsd-2-text",
    ),
]


def template_grams(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """``gram, then, template, at, k, v0, v1, ...``: a row per gram of each template.

    A long gram is a short one and what comes ``then``.
    Bit ``i`` of ``v0, v1, ...`` together is set if the gram shows word ``i`` of the
    template. One more row, of template ``WORDS``, meets the number of words of a text.
    """
    if any(t.size < K for t in templates):
        raise ValueError(f"a template needs {K} words")
    rows = [(i, t.text, t.k) for i, t in enumerate(templates)]
    listed = spark.createDataFrame(rows, "template int, text string, k int")
    seen = listed.select("template", "k", F.posexplode(_grams(lower_words(F.col("text"), GAP))).alias("at", "p"))
    short = F.col("k") == K
    grams = seen.where((F.col("p.gram") != _number()) & (short | F.col("p.next").isNotNull())).select(
        F.col("p.gram").alias("gram"), F.when(~short, F.col("p.next")).alias("then"), "template", "at", "k"
    )

    def shown(part: int) -> Column:
        bits = F.lit(0).cast("long")
        for j in range(LONG_K):
            word = F.col("at") + j
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), (word % BITS).cast("int"))
            here = (F.floor(word / BITS) == part) & (F.lit(j) < F.col("k"))
            bits = bits.bitwiseOR(F.when(here, bit).otherwise(F.lit(0).cast("long")))
        return bits

    words = spark.range(1).select(
        _number().alias("gram"), F.lit(None).cast("long").alias("then"), F.lit(WORDS).alias("template"), F.lit(0).alias("at"), F.lit(K).alias("k")
    )
    votes = _votes(templates)
    return grams.select("*", *[shown(p).alias(v) for p, v in enumerate(votes)]).unionByName(
        words.select("*", *[F.lit(0).cast("long").alias(v) for v in votes])
    )


def _votes(templates: list[Template]) -> list[str]:
    """Names of the columns of votes: one for every 64 words of the longest template."""
    return [f"v{p}" for p in range(-(-max((t.size for t in templates), default=1) // BITS))]


def _number() -> Column:
    """What stands for a gram in the row with a text's number of words."""
    return F.xxhash64(F.lit("number of words"))


def _grams(w: Column) -> Column:
    """``gram, next`` of every run of ``K`` words and of the run after it, and the number of words."""

    def pairs(words: Column) -> Column:
        n = F.greatest(F.size(words) - (K - 1), F.lit(0))
        return F.zip_with(F.slice(words, 1, n), F.slice(words, K, n), lambda a, b: F.xxhash64(a, b))

    def of(words: Column) -> Column:
        after = lambda g: F.arrays_zip(g, F.slice(g, K + 1, F.size(g)))
        number = F.array(F.struct(_number().alias("gram"), F.size(words).cast("long").alias("next")))
        return F.concat(let(pairs(words), after).cast("array<struct<gram:bigint,next:bigint>>"), number)

    return let(w, of)


def diagonals(docs: DataFrame, templates: list[Template], keys: list[str], text: str) -> DataFrame:
    """``keys, template, diagonal, v0, ..., first, last, n`` of all hits; rows of equal keys hold equal texts.

    The row of template ``WORDS`` has the number of words as ``first`` and that of rows as ``n``.
    """
    seen = docs.select(*keys, F.posexplode(_grams(lower_words(F.col(text), GAP))).alias("pos", "p"))
    # The templates are a list in the program, so the broadcast is bounded by it.
    listed = F.broadcast(template_grams(docs.sparkSession, templates)).withColumnRenamed("gram", "known")
    same = (F.col("p.gram") == F.col("known")) & (F.col("then").isNull() | (F.col("p.next") == F.col("then")))
    hits = seen.join(listed, same)
    return hits.groupBy(*keys, "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        *[F.bit_or(v).alias(v) for v in _votes(templates)],
        F.min(F.when(F.col("template") == WORDS, F.col("p.next")).otherwise(F.col("pos"))).alias("first"),
        (F.max(F.col("pos") + F.col("k")) - 1).alias("last"),
        F.count("*").alias("n"),
    )


def spans(found: DataFrame, templates: list[Template], keys: list[str]) -> DataFrame:
    """Places of exact templates and verified spans of the others.

    ``keys, template, first, last, score``; the score is the smaller of the two shares.
    """
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("template") + 1)
    found = found.where(F.col("template") != WORDS)
    size, exact = of([t.size for t in templates]), of([t.exact for t in templates])
    votes = _votes(templates)
    matched = lambda x: reduce(add, [F.bit_count(x(v)) for v in votes])
    # On one diagonal all words shown are all words in place.
    all_words = matched(F.col) == size
    whole = found.where(all_words).select(*keys, "template", "first", "last", F.lit(1.0).alias("score"))
    order = W.partitionBy(*keys, "template").orderBy("diagonal")
    chain = W.partitionBy(*keys, "template", "span")
    reach = F.greatest(F.lit(float(NEAR)), size * NEAR_SHARE)
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > reach, F.lit(True))
    # At most NEAR + 1 diagonals, the row's own first.
    near = F.collect_list(F.struct(*votes, "first", "last")).over(order.rangeBetween(0, NEAR))
    joined = (
        found.where(~exact)
        .withColumn("apart", apart.cast("long"))
        .withColumn("near", near)
        .withColumn("span", F.sum("apart").over(order))
        .withColumn("whole", F.max(all_words).over(chain))
        .withColumn(
            "all",
            F.struct(
                *[F.bit_or(v).over(chain).alias(v) for v in votes],
                F.min("first").over(chain).alias("first"),
                F.max("last").over(chain).alias("last"),
            ),
        )
        .where(~F.col("whole"))
    )

    def chosen(mask: Column) -> Column:
        # Bit i of the mask is the row's neighbour i + 1.
        bit = lambda i: F.call_function("shiftright", mask, i - 1).bitwiseAND(F.lit(1)) == 1
        parts = F.filter("near", lambda x, i: (i == 0) | bit(i))
        either = lambda v: F.aggregate(parts[v], F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
        return F.struct(
            *[either(v).alias(v) for v in votes],
            F.array_min(parts["first"]).alias("first"),
            F.array_max(parts["last"]).alias("last"),
        )

    def scored(x: Column) -> Column:
        shown = matched(lambda v: x[v])
        coverage, density = shown / size, F.least(F.lit(1.0), shown / (x["last"] - x["first"] + 1))
        verified = (coverage >= COVERED) & (density >= DENSE)
        return F.when(verified, F.struct(F.least(coverage, density).alias("score"), x["first"].alias("first"), x["last"].alias("last")))

    masks = F.sequence(F.lit(0), F.call_function("shiftleft", F.lit(1), F.size("near") - 1) - 1)
    tried = F.concat(F.transform(masks, chosen), F.array("all"))
    verified = (
        joined.withColumn("best", F.array_max(F.transform(tried, scored)))
        .groupBy(*keys, "template", "span")
        .agg(F.max("best").alias("best"))
        .where("best IS NOT NULL")
        .select(*keys, "template", "best.first", "best.last", "best.score")
    )
    return whole.unionByName(verified)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: list[Template] | None = None) -> DataFrame:
    """One row per document with its places, labels and score (0 without any, 1 for a whole phrase)."""
    templates = BASE + (PHRASES + TEXTS if phrases is None else phrases)
    keys = ["doc_id", "text_key"]
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        text_key(F.col(f"`{text}`")).alias("text_key"),
        F.col(f"`{text}`").alias("text"),
    )
    met = written(diagonals(rows, templates, keys, "text"), "diagonals")
    numbers = met.where(F.col("template") == WORDS).select(
        *keys, "template", F.col("first").alias("n_words"), F.col("n").alias("copies")
    )
    found = spans(met, templates, keys).unionByName(numbers, allowMissingColumns=True)
    base = F.col("template").between(0, len(BASE) - 1)
    label = F.get(F.array(*[F.lit(t.label) for t in templates]), F.col("template"))
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    summary = found.groupBy(*keys).agg(
        F.max("n_words").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        joined(F.collect_set(F.when(base, label))).alias("base_labels"),
        joined(F.collect_set(label)).alias("labels"),
        F.coalesce(F.max("score"), F.lit(0.0)).alias("score"),
        F.max("copies").alias("copies"),
    )
    # Equal rows were worked on once; each gets its result, some thousands at a time.
    left = F.col("copies") - F.col("chunk") * COPIES
    chunks = summary.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES).cast("int"))))
    return chunks.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(left, F.lit(COPIES)).cast("int")))).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
