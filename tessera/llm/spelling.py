"""Spelling variants: words one edit apart, each led to its most frequent form.

1. Count. Python counts the words of each batch of texts; Spark sums them.
2. Dictionary. All grams of ``QMIN`` to ``QMAX`` characters of the words (with a mark before
   and after) are counted. Frequent ones stay in the dictionary's table and are extended; a
   gram that is not frequent ends there. A frequent gram has more than 1 / ``TABLE`` of all
   counted grams, so the table has at most ``TABLE`` entries, whatever the corpus.
3. Decompose. At each place of a word its gram grows until it is not frequent or has half
   the marked word's length (``QMAX`` at most); grams inside an earlier one are left out.
4. Bounds. An edit at place e affects at most the grams that end in the ``longest`` places
   after e. As no gram is longer than half the word, two of its grams exist that no single
   edit affects both: one that ends before, one that ends ``longest`` places later or more.
   The word probes with the two rarest such grams. The left one keeps its distance from the
   beginning, the right one from the end, so lists are kept by gram, side and place.
5. Merge and verify. Both lists are joined, only pairs at one edit become rows, and a pair
   found by both is kept once.

Words of n characters meet words of n and n + 1 characters in class n, whose grams grow to
half of n + 2; each word is so indexed in two classes, and each pair meets in one.
Lists with many probes are salted.

Defined results: a null text has no words; a null identifier counts as an empty one;
repeated rows count each; words of any length are compared whole; equal counts are settled by
the code points' order; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.cut import Tables, written
from tessera.plans.skew import salted_join

#: Characters of runs; of runs, one in ``SLIP`` loses a character.
RUN, SLIP = "[A-Za-zÀ-ÿ]+", 97
#: Characters and occurrences that a word needs; times that a form must be as frequent.
LENGTH, OCCURRENCES, TIMES = 5, 3, 2
#: Characters of grams, entries of the dictionary's table, least count of a frequent gram.
QMIN, QMAX, TABLE, FREQUENT = 2, 8, 1 << 18, 64
#: Entries that a task holds before it passes them on.
HELD = 300_000
#: Marks before and after a word; runs hold neither.
BEFORE, AFTER = "\x02", "\x03"


def slipped(doc: str, run: str) -> str:
    """The run as this document spells it: where ``SLIP`` divides a hash, a character is missing."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _summed(held: dict, names: tuple[str, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())], names)


def words(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``word, n`` of all words that are long and frequent enough."""
    found = re.compile(RUN).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            for doc, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts: dict[str, int] = {}
                # bytes.lower() knows A-Z only.
                for word in found(own.encode().lower().decode()):
                    counts[word] = counts.get(word, 0) + 1
                for word, n in counts.items():
                    word = slipped(doc, word)
                    if len(word) >= LENGTH:
                        held[word] = held.get(word, 0) + n
                if len(held) >= HELD:
                    yield _summed(held, ("word", "n"))
                    held = {}
        if held:
            yield _summed(held, ("word", "n"))

    blank = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((id, "doc"), (text, "text"))]
    counts = docs.select(*blank).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= OCCURRENCES)


def dictionary(vocabulary: DataFrame, table: int = TABLE, frequent: int = FREQUENT) -> dict[str, int]:
    """The frequent grams and their counts, at most ``table`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            for word in batch.column(0).to_pylist():
                word = BEFORE + word + AFTER
                for q in range(QMIN, QMAX + 1):
                    for at in range(len(word) - q + 1):
                        gram = word[at : at + q]
                        held[gram] = held.get(gram, 0) + 1
                if len(held) >= HELD:
                    yield _summed(held, ("gram", "n"))
                    held = {}
        if held:
            yield _summed(held, ("gram", "n"))

    grams = vocabulary.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    with Tables() as own:
        grams = written(grams, "grams")
        limit = max(frequent, (grams.agg(F.sum("n")).first()[0] or 0) // table)
        found = {row["gram"]: row["n"] for row in grams.where(F.col("n") > limit).collect()}
    own.release(vocabulary.sparkSession)
    return found


def decompose(word: str, longest: int, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """Start and end of the grams of a marked word; the ends rise."""
    found, size, last = [], len(word), 0
    for at in range(size - 1):
        # A gram grows while it is frequent, and stops at the word's end.
        most, end = min(at + longest, size), min(at + QMIN, size)
        while end < most and word[at:end] in frequent:
            end += 1
        if end > last:
            found.append((at, end))
            last = end
            if end == size:
                break
    return found


def probes(word: str, grams: list[tuple[int, int]], longest: int, frequent: dict[str, int]) -> tuple[int, int]:
    """Numbers of the two rarest grams that no single edit affects both."""
    costs = [frequent.get(word[s:e], 0) for s, e in grams]
    best, left, head = None, 0, 0
    for right, (_, end) in enumerate(grams):
        while grams[head][1] + longest <= end:
            left = head if head == 0 or costs[head] < costs[left] else left
            head += 1
        if head and (best is None or costs[left] + costs[right] < best[0]):
            best = (costs[left] + costs[right], left, right)
    return best[1:]


def _index(vocabulary: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """``class, key, word, probe``: the lists of each class, and what each word asks for."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(frequent)

    def rows(word: str, of: int) -> Iterator[tuple]:
        marked = BEFORE + word + AFTER
        longest = min(QMAX, (of + 2) // 2)
        grams = decompose(marked, longest, shared.value)
        asks = probes(marked, grams, longest, shared.value) if len(word) == of else (None, None)
        size = len(marked)
        for i, (start, end) in enumerate(grams):
            gram = marked[start:end]
            yield xxhash.xxh3_64_intdigest(f"{of}<{start}{gram}"), word, i == asks[0]
            yield xxhash.xxh3_64_intdigest(f"{of}>{size - start}{gram}"), word, i == asks[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                row for word in batch.column(0).to_pylist() for of in (len(word), len(word) - 1) if of >= LENGTH for row in rows(word, of)
            ]
            keys, own, asks = zip(*made) if made else ((), (), ())
            columns = [pa.array(keys, pa.uint64()).view(pa.int64()), pa.array(own, pa.string()), pa.array(asks, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "word", "probe"])

    return vocabulary.select("word").mapInArrow(run, "key long, word string, probe boolean")


def near_pairs(vocabulary: DataFrame, table: int = TABLE, frequent: int = FREQUENT) -> DataFrame:
    """``a, b``: all pairs of words one edit apart, in both directions."""
    spark = vocabulary.sparkSession
    with Tables() as early:
        index = written(_index(vocabulary, dictionary(vocabulary, table, frequent)), "grams")
    asked = index.where("probe").select("key", F.col("word").alias("a"))
    lists = index.select("key", F.col("word").alias("b"))
    # The shorter word asks, of words of one length the smaller one.
    shorter, longer = F.length("a"), F.length("b")
    met = salted_join(asked, lists, ["key"], ["a"], 256).where(
        ((shorter < longer) | ((shorter == longer) & (F.col("a") < F.col("b")))) & (F.levenshtein("a", "b", 1) == 1)
    )
    pairs = written(met.select("a", "b").distinct(), "pairs")
    early.release(spark)
    return pairs.union(pairs.select("b", "a"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: the last word that forms lead to.

    Counts at least double along forms, so paths are short; each round halves them.
    """
    step = forms.select("word", F.coalesce("form", "word").alias("root"), F.lit(True).alias("moved"))
    while True:
        step = written(step, "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        ahead = step.where("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = step.join(ahead, "root", "left")
        step = further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))


def variants(
    docs: DataFrame, text: str = "text", id: str = "doc_id", table: int = TABLE, frequent: int = FREQUENT
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words."""
    vocabulary = written(words(docs, text, id), "words")
    pairs = near_pairs(vocabulary, table, frequent)
    named = pairs.join(vocabulary.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    near = named.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word"))).alias("best")
    )
    best = -F.col("best.n")
    led = best >= TIMES * F.col("n")
    found = vocabulary.join(near, "word", "left").select(
        "word", F.when(led, F.col("best.word")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(led, best).alias("form_n"),
    )
    found = written(found, "forms")
    return found.join(roots(found), "word").select("word", "form", "root", "n", "n_near", "form_n")
