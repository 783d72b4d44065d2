"""Exact duplicates of normalised texts, found by sorting contents.

1. Normalise. Each run of blanks becomes one space; the rows are written once, with a
   64-bit hash of the text.
2. Sort. Sampled splitters range-partition rows by the first bytes of the text, then
   its hash, so that a common beginning does not fill a range; an external sort by the
   whole bytes and the identifier then places equal texts side by side.
3. Compare. A row begins a new class where its whole text differs from its neighbour's
   above; texts go no further. The smallest identifier of a class stays.

A text with more copies (or bytes of copies) than a range should hold is spread over
salts by row number, each salt is a class of its own, and the first rows of these
classes are combined by hash and whole text. There are at most four such texts for each
shuffle partition, plus one for each ``BYTES`` of input, which bounds the list of them.

Everything is DataFrame code. Defined results: a null text is empty; texts are not
trimmed; a null identifier stands after all others (a class of nulls only keeps one of
its rows, with a null ``keep_id``); of rows with equal text and identifier exactly one
is kept; long texts are compared whole; an empty table gives an empty table; other
columns are carried in the struct ``doc`` and may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.cut import Tables, written

#: Leading characters that range splitters see; bytes of one text's copies in one range.
HEAD, BYTES = 32, 16_000_000
#: Rows of one text that may stay together, however few a range holds.
FEW = 64


def normalised(text: Column) -> Column:
    """The text with each run of blanks as one space; null is empty."""
    # Single spaces stay as they are, so only other runs need replacing.
    odd = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), odd, " ")


def _rows(docs: DataFrame, columns: list[str], text: str, id: str) -> DataFrame:
    """``row, doc, id, text, hash`` of every document."""
    norm = normalised(F.col(f"`{text}`"))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
        F.col(f"`{id}`").alias("id"),
        norm.alias("text"),
    ).withColumn("hash", F.xxhash64("text"))


def _spread(rows: DataFrame) -> DataFrame:
    """``parts``, over how many salts a text's copies go, and each row's ``salt``."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(FEW, rows.count() // (4 * ranges))
    sizes = rows.groupBy("hash").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    parts = F.ceil(F.greatest(F.col("n") / most, F.col("bytes") / BYTES)).cast("long")
    # Bounded, see above.
    hot = F.broadcast(sizes.where((F.col("n") > most) | ((F.col("bytes") > BYTES) & (F.col("n") > 1))).select("hash", parts.alias("parts")))
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    return rows.join(hot, "hash", "left").withColumn("parts", parts).withColumn("salt", F.pmod(F.xxhash64("row"), "parts"))


def _order() -> list[Column]:
    return [F.col("id").asc_nulls_last(), F.col("row").asc()]


def classes(docs: DataFrame, columns: list[str], text: str = "text", id: str = "doc_id") -> DataFrame:
    """Each document's ``doc``, ``id, row`` and its class: ``keep_id, keep_row, group_size, sha256``.

    ``doc`` holds ``columns``; the row with ``row = keep_row`` is the one that stays.
    """
    with Tables() as early:
        rows = written(_rows(docs, columns, text, id), "normalised")
    spread = _spread(rows).withColumn("head", F.substring("text", 1, HEAD))
    ranged = spread.repartitionByRange("head", "hash", "salt")
    place = ["head", "hash", "salt"]
    above = Window.partitionBy(*place).orderBy("text", *_order())
    first = F.coalesce(F.lag("text").over(above) != F.col("text"), F.lit(True))
    compared = ranged.withColumn("first", first)
    compared = compared.withColumn("class", F.sum(F.col("first").cast("long")).over(above))
    # Of a class, one row carries the digest, and of a spread one the text as well.
    compared = compared.select(
        *place, "class", "parts", "doc", "id", "row", "first",
        F.when(F.col("first"), F.sha2("text", 256)).alias("sha256"),
        F.when(F.col("first") & (F.col("parts") > 1), F.col("text")).alias("text"),
    )
    own = Window.partitionBy(*place, "class")
    least = own.orderBy(*_order())
    marked = compared.select(
        *place, "class", "parts", "doc", "id", "row", "first", "text",
        F.first("sha256").over(least).alias("sha256"),
        F.first("id").over(least).alias("keep_id"),
        F.first("row").over(least).alias("keep_row"),
        F.count("*").over(own).alias("group_size"),
    )
    marked = written(marked, "classes")
    early.release(docs.sparkSession)
    result = ["doc", "id", "row", "keep_id", "keep_row", "group_size", "sha256"]
    whole = marked.where("parts = 1").select(*result)
    # The salts of a text that was spread meet by their first rows.
    heads = marked.where("parts > 1 AND first").select(*place, "class", "text", "keep_id", "keep_row", "group_size")
    total = heads.groupBy("hash", "text").agg(
        F.min(F.struct(F.col("keep_id").isNull().alias("last"), "keep_id", "keep_row")).alias("least"),
        F.sum("group_size").alias("all"),
    )
    total = heads.select(*place, "class", "text").join(written(total, "spread-texts"), ["hash", "text"])
    total = written(total.select(*place, "class", "least", "all"), "spread-classes")
    spread = marked.where("parts > 1").join(total, [*place, "class"])
    spread = spread.select(
        "doc", "id", "row",
        F.col("least.keep_id").alias("keep_id"), F.col("least.keep_row").alias("keep_row"),
        F.col("all").alias("group_size"), "sha256",
    )
    return whole.unionByName(spread)


def mark(docs: DataFrame, columns: list[str] | None = None, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Each document's ``doc`` (``columns``, or all), ``keep_id, group_size, kept, text_sha256``."""
    found = classes(docs, docs.columns if columns is None else columns, text, id)
    kept = (F.col("row") == F.col("keep_row")).alias("kept")
    return found.select("doc", "keep_id", "group_size", kept, F.col("sha256").alias("text_sha256"))


def keep_first(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The documents that stay, with their columns."""
    return mark(docs, None, text, id).where("kept").select("doc.*")
