"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits. Two that differ in at most ``BITS`` = 4 bits differ in
at most one bit of some of three blocks (21, 21 and 22 bits). In a block the
anchors are the words of a covering code: the perfect Hamming code on 15 bits
and every pattern on the others, so that each value is within radius 1 of one
anchor, its home. A fingerprint is replicated to all anchors within radius 1
plus threshold 1; two that differ in at most one bit of the block meet at the
home of either. All meetings at an anchor are compared over all 64 bits.

Equal fingerprints are one class first, so copies never meet each other. At an
anchor only links that join two groups are written, not all pairs; an anchor
with many fingerprints is dealt over pairs of chunks. Components come from
alternating star contractions in Spark tables.

Defined results: null and empty texts have the fingerprint zero, fewer words
than a shingle are one shingle; repeated rows get the same result each; null
ids take no part in the smallest id; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.cut import written

SHINGLE = 4
SEED = 42
BITS = 4
#: First bit and number of bits of the blocks.
BLOCKS = ((0, 21), (21, 21), (42, 22))
CODED = 15
#: Fingerprints of one anchor that one task compares with as many others.
CHUNK = 4096
#: Copies of a small side that a hub's rows are dealt over.
SALTS = 8

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text as an unsigned 64-bit number."""
    w = (text or "").encode().translate(_LOWER).split()
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    grams = map(b" ".join, zip(*[w[i : i + n] for i in range(min(shingle, len(w)))]))
    hashes = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], dtype="<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without the text, with ``fp`` (the bits as a long)."""
    others = [c for c in docs.columns if c != text]
    schema = T.StructType([docs.schema[c] for c in others] + [T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(text)]
            found = pa.array(np.array(fps, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), found], [*others, "fp"])

    return docs.mapInArrow(run, schema)


def _syndromes(values: np.ndarray) -> np.ndarray:
    """Syndromes of the Hamming code on the low 15 bits: bit i has the column i + 1."""
    found = np.zeros(len(values), np.int64)
    for i in range(CODED):
        found ^= ((values >> np.int64(i)) & 1) * (i + 1)
    return found


def _patterns(width: int) -> list[np.ndarray]:
    """For each syndrome, the error patterns of weight 2 at most that lead to an anchor; the home first."""
    weights = [0, *(1 << i for i in range(width))]
    errors = [0, *weights[1:], *(a | b for a, b in combinations(weights[1:], 2))]
    all_errors = np.array(errors, np.int64)
    syndromes = _syndromes(all_errors)
    # Errors stand by weight; within the first of a syndrome's, a coded bit stands before the others.
    return [all_errors[syndromes == s] for s in range(16)]


def anchors(classes: DataFrame) -> DataFrame:
    """``anchor, home, fp``: every anchor that a fingerprint is replicated to."""
    tables = [_patterns(width) for _, width in BLOCKS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("fp").to_numpy()
            for at in range(0, len(every), 8192):
                fps = every[at : at + 8192]
                for block, (first, width) in enumerate(BLOCKS):
                    values = (fps >> np.int64(first)) & np.int64((1 << width) - 1)
                    syndromes = _syndromes(values)
                    for s, errors in enumerate(tables[block]):
                        own = syndromes == s
                        if own.any():
                            near = (values[own][:, None] ^ errors[None, :]) | (block << 32)
                            home = np.zeros(near.shape, bool)
                            home[:, 0] = True
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(near.ravel()),
                                    pa.array(home.ravel()),
                                    pa.array(np.repeat(fps[own], len(errors))),
                                ],
                                ["anchor", "home", "fp"],
                            )

    return classes.select("fp").mapInArrow(run, "anchor long, home boolean, fp long")


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits; as unsigned numbers, for numpy counts the bits of a signed one's size."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _few_links(home: np.ndarray, every: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links from ``home`` to ``every`` that join two groups; not all of a dense group's pairs."""
    every, group = np.unique(np.concatenate([every, home])), None
    group = np.arange(len(every))
    for fp in home:
        near = np.flatnonzero(_distance(every, fp) <= bits)
        own = group[np.searchsorted(every, fp)]
        others, first = np.unique(group[near], return_index=True)
        new = others != own
        if new.any():
            yield np.full(new.sum(), fp), every[near[first[new]]]
            group[np.isin(group, others)] = own


def _pairs(starts: np.ndarray, sizes: np.ndarray, home: np.ndarray, fps: np.ndarray, bits: int):
    """Links in many small groups at once: each home row against its group's rows."""
    rows = np.flatnonzero(home)
    group = np.searchsorted(starts, rows, side="right") - 1
    n = sizes[group]
    left = np.repeat(rows, n)
    right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[group], n)
    found = (_distance(fps[left], fps[right]) <= bits) & (fps[left] != fps[right])
    return fps[left[found]], fps[right[found]]


def _compare(bits: int):
    """Compare the rows of each key; rows come sorted by key, a key may go on in the next batch."""

    def links(keys: np.ndarray, home: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        big = sizes > 32
        found = []
        for s, n in zip(starts[big], sizes[big]):
            own = home[s : s + n]
            found += _few_links(np.unique(fps[s : s + n][own]), fps[s : s + n], bits)
        small = np.repeat(~big, sizes)
        if small.any():
            n = sizes[~big]
            found.append(_pairs(np.cumsum(n) - n, n, home[small], fps[small], bits))
        a = np.concatenate([x for x, _ in found]) if found else np.empty(0, np.int64)
        b = np.concatenate([y for _, y in found]) if found else np.empty(0, np.int64)
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(lo), pa.array(hi)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            part = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "home", "fp")]
            held.append(part)
            if part[0][0] != part[0][-1] or len(held) > 1 and held[0][0][0] != part[0][-1]:
                keys, home, fps = (np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut:
                    yield from links(keys[:cut], home[:cut], fps[:cut])
                held = [[keys[cut:], home[cut:], fps[cut:]]]
        if held:
            yield from links(*(np.concatenate(x) for x in zip(*held)))

    return run


def links(classes: DataFrame, bits: int = BITS) -> DataFrame:
    """``a, b``: links between different fingerprints that give the same components as all links."""
    if bits != BITS:
        raise ValueError(f"the blocks and anchors are laid out for {BITS} bits")
    met = anchors(classes)
    # Keys above CHUNK rows: at most a row for each CHUNK rows of the table.
    hot = met.groupBy("anchor").count().where(F.col("count") > CHUNK)
    hot = hot.select("anchor", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    # Written, so that Spark knows its size and broadcasts it only while that is small.
    hot = written(hot, "hot-anchors")
    rows = met.join(hot, "anchor", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    # A task (i, j) has the home rows of chunk i and all rows of chunk j.
    left = rows.where("home").withColumn("i", own).withColumn("j", every)
    right = rows.withColumn("i", every).withColumn("j", own).withColumn("home", F.lit(False))
    right = right.where("chunks > 1").unionByName(
        rows.where("chunks = 1").withColumns({"i": F.lit(0), "j": F.lit(0)})
    )
    tasks = left.where("chunks > 1").unionByName(right)
    keyed = tasks.select(F.xxhash64("anchor", "i", "j").alias("key"), "home", "fp")
    sorted_rows = keyed.repartition("key").sortWithinPartitions("key")
    return sorted_rows.mapInArrow(_compare(bits), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a < b``); the root is the smallest node reached.

    Alternates two contractions until nothing changes: link larger neighbours to
    the smallest one, then smaller ones. A hub's rows are dealt over salts.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))

    def with_least(rows: DataFrame) -> DataFrame:
        """``u, v`` with ``m``, the smallest ``v`` of ``u`` or ``u`` itself."""
        least = rows.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        dealt = rows.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
        return dealt.join(least.withColumn("salt", salts), ["u", "salt"])

    edges, before = written(edges, "links"), None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        before = now
        both = edges.select(F.inline(F.array(
            F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))
        )))
        large = with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = with_least(large).select(F.inline(F.array(
            F.struct(F.col("m").alias("a"), F.col("u").alias("b")), F.struct(F.col("m").alias("a"), F.col("v").alias("b"))
        ))).where("a < b").distinct()
        edges = written(small, "links")


def groups(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """``rows`` (with ``doc_id`` and ``fp``) with ``root``, the group, and ``component_id``, its smallest id."""
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes")
    found = components(links(classes, bits))
    rooted = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    # Written, so that the join of a component with very many classes can be split.
    ids = written(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "components")
    return rows.join(rooted.join(ids, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` for every row."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return groups(written(fingerprints(rows), "fingerprints")).drop("root")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, that with the smallest id, with its columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row_key = F.xxhash64(*columns)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), row_key.alias("row_key"), F.col(f"`{text}`").alias("text"))
    grouped = groups(written(fingerprints(rows), "fingerprints"))
    # Null ids come last.
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first")
    kept = grouped.groupBy("root").agg(first).select("first.doc_id", "first.row_key")
    kept = kept.select(F.xxhash64("doc_id", "row_key").alias("kept_key"))
    keyed = docs.select(F.struct("*").alias("doc"), F.xxhash64(F.col(f"`{doc_id}`"), row_key).alias("kept_key"))
    return keyed.join(kept, "kept_key", "left_semi").dropDuplicates(["kept_key"]).select("doc.*")
