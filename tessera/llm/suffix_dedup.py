"""Repeated passages: every byte under a string of ``LENGTH`` bytes that also starts elsewhere.

1. Cut. Each window of ``LENGTH`` bytes has an anchor, the gram of ``GRAM`` bytes
   with the smallest hash in it. Windows in a row with one anchor are a segment.
   Equal windows have equal anchors, so only segments of one anchor can share one.
2. Count. Segments with equal bytes are one content; where a content stands twice,
   all its windows do. Counting combines on the map side, so that copies are
   cheap, however many there are.
3. Sort. Anchors with several contents are dealt over shards. Windows with most of
   their bytes in one content only stand once (``alike``); the suffixes of the others'
   bytes are sorted by external induced sorting with their common prefixes
   (``suffixes.py``). Many contents of one anchor make one larger shard. Beyond ``HOT``
   of them, some 50 MB, the anchor's windows are hashed and counted one by one instead.
4. Mark. Windows found go back to all segments of their content, and to texts.

Anchors are compared by 64-bit hashes, contents by 64 bits more, bytes in shards as they are.

Defined results: a null text is empty; texts shorter than ``LENGTH`` keep all;
repeated rows are places of their own, worked on once; an empty table gives an empty table. A
removed span may begin or end inside a character's bytes; ``without_repeats``
then drops what is left of that character.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import suffixes
from tessera.plans.cut import Tables, written

LENGTH, GRAM = 400, 32
#: Bytes of a shard, and contents of an anchor that still go to one.
SHARD, HOT = 1_000_000, 1 << 16
#: Bytes that are cut at once: few, as there are some numbers for each, which a core's cache should hold.
BUFFER = 1 << 17

# Odd multipliers of the rolling hash.
_STEP, _MIX = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD
_MASK = (1 << 64) - 1


#: What a row is known by: a hash of all its columns, and its text's bytes. Equal rows have equal spans.
KEYS = ["key", "size"]


def _keys(docs: DataFrame, text: str) -> list[Column]:
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0))
    return [F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("key"), size.alias("size")]


def _bytes(texts: pa.StringArray) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Mixed polynomial hashes of all ``size`` bytes in a row; ``size`` is a power of two."""
    found = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(_MIX)
    width = 1
    while width < size:
        found = found[:-width] * np.uint64(pow(_STEP, width, 1 << 64)) + found[width:]
        width *= 2
    found = (found ^ (found >> np.uint64(32))) * np.uint64(_MIX)
    return found ^ (found >> np.uint64(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if span < width else values


def cut(data: np.ndarray, sizes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Segments of texts laid end to end: anchor hashes, texts' numbers, first window, number of windows."""
    if len(data) < length:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    hashes = gram_hashes(data, gram)
    # The upper half orders grams, the lower half is the place: of equal ones the first wins.
    at = np.arange(len(hashes), dtype=np.uint64)
    least = _least((hashes & np.uint64(0xFFFFFFFF00000000)) | at, length - gram + 1)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(anchor)]
    whole = np.arange(len(anchor)) + length <= ends[text]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (whole[1:] != whole[:-1]))
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(anchor)))
    kept = whole[first]
    first, windows = first[kept], windows[kept]
    return hashes[anchor[first]].view(np.int64), text[first], first - (ends - sizes)[text[first]], windows


def _anchors(
    joined: bytes, anchor: np.ndarray, at: np.ndarray, sizes: np.ndarray, gram: int
) -> Iterator[np.ndarray]:
    """The anchors' places in ``joined``: the first gram of each content with that hash."""
    ends = at + sizes
    start = 0
    while start < len(at):
        stop = max(start + 1, int(np.searchsorted(ends, at[start] + BUFFER, "right")))
        hashes = gram_hashes(np.frombuffer(joined, np.uint8)[at[start] : ends[stop - 1]], gram).view(np.int64)
        hits = np.flatnonzero(hashes == np.repeat(anchor[start:stop], sizes[start:stop])[: len(hashes)]) + at[start]
        _, first = np.unique(np.searchsorted(at[start:stop], hits, "right"), return_index=True)
        yield hits[first]
        start = stop


def alike(
    joined: bytes, anchor: np.ndarray, at: np.ndarray, windows: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray]:
    """Runs of windows (first places and numbers) that can stand in another content of their anchor.

    Contents from ``at`` on in ``joined``. Equal windows have their anchor at one place, so
    windows that begin up to a quarter of the possible places apart have most of their bytes in
    common: where no other content has these bytes, none has one of the windows. What is left
    may hold windows that stand once.
    """
    place = np.concatenate([np.empty(0, np.int64), *_anchors(joined, anchor, at, windows + (length - 1), gram)])
    width = -(-(length - gram + 1) // 4)
    # Windows by how far before the anchor they begin, from the nearest to the farthest.
    nearest, farthest = place - at - windows + 1, place - at
    steps = farthest // width - nearest // width + 1
    row = np.repeat(np.arange(len(at)), steps)
    step = np.arange(len(row)) - np.repeat(np.cumsum(steps) - steps, steps) + (nearest // width)[row]
    starts = (place[row] - step * width).tolist()
    common = list(zip(anchor[row].tolist(), step.tolist(), [joined[s : s + length - width + 1] for s in starts]))
    times = Counter(common)
    kept = np.flatnonzero([times[c] > 1 for c in common])
    row, step = row[kept], step[kept]
    last = place[row] - np.maximum(step * width, nearest[row])
    start = place[row] - np.minimum(step * width + width - 1, farthest[row])
    # Steps go back from the anchor, places in the text forward.
    order = np.argsort(start)
    start, last = start[order], last[order]
    new = np.append(True, start[1:] != last[:-1] + 1)[: len(start)]
    head = np.flatnonzero(new)
    return start[head], np.append(last[head[1:] - 1], last[-1:]) - start[head] + 1


SEGMENTS = "key long, size int, anchor long, content long, first int, windows int, run int"


def segments(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``SEGMENTS`` of ``key, size, text``; ``run`` windows of equal bytes in a row are one row."""

    def flush(keys: list, texts: list[bytes]) -> pa.RecordBatch:
        joined = b"".join(texts)
        sizes = np.array([len(t) for t in texts])
        anchor, text, first, windows = cut(np.frombuffer(joined, np.uint8), sizes, length, gram)
        starts = (np.cumsum(sizes) - sizes)[text] + first
        whole = memoryview(joined)
        content = np.array(
            [xxhash.xxh3_64_intdigest(whole[s:e]) for s, e in zip(starts.tolist(), (starts + windows + length - 1).tolist())],
            np.uint64,
        ).view(np.int64)
        again = np.zeros(len(first), bool)
        again[1:] = (content[1:] == content[:-1]) & (starts[1:] == starts[:-1] + 1) & (text[1:] == text[:-1])
        again &= windows == 1
        head = np.flatnonzero(~again)
        run = np.diff(np.append(head, len(first)))
        own = text[head]
        columns = [np.array(keys, np.int64)[own], anchor[head], content[head]]
        small = [sizes[own], first[head], windows[head], run]
        key, anchor, content = (pa.array(np.ascontiguousarray(c)) for c in columns)
        size, first, windows, run = (pa.array(c.astype(np.int32)) for c in small)
        names = [c.split()[0] for c in SEGMENTS.split(", ")]
        return pa.RecordBatch.from_arrays([key, size, anchor, content, first, windows, run], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, held = [], [], 0
        for batch in batches:
            for key, own in zip(batch.column("key").to_pylist(), _bytes(batch.column("text"))):
                if len(own) >= length:
                    keys.append(key)
                    texts.append(own)
                    held += len(own)
                    if held >= BUFFER:
                        yield flush(keys, texts)
                        keys, texts, held = [], [], 0
        if texts:
            yield flush(keys, texts)

    return rows.mapInArrow(run, SEGMENTS)


def repeats(rows: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    """``key, size, spans`` of ``rows`` (``KEYS, doc, text``) with repeated bytes: the windows' spans, not merged."""
    content = ["anchor", "content"]
    with Tables() as early:
        held = written(segments(rows.select(*KEYS, "text"), length, gram), "segments")
        # Most anchors stand once and go no further. (Grouped tables are written before
        # they are joined, so that a hot anchor's join can be split.)
        again = held.groupBy("anchor").agg(F.sum("run").alias("n")).where("n > 1").select("anchor")
        again = written(again, "anchors")
    # Equal rows have equal segments, which go on as one with their number.
    pool = held.join(again, "anchor", "left_semi").groupBy(*held.columns).agg(F.count("*").alias("copies"))
    pool = written(pool, "repeated-anchors")
    # Nothing below reads these two again.
    early.release(rows.sparkSession)
    contents = written(
        pool.groupBy(*content).agg(
            F.sum(F.col("run") * F.col("copies")).alias("places"), F.min(F.struct(*KEYS, "first", "windows")).alias("owner")
        ),
        "contents",
    )
    # Anchors with several contents, of which some stand once.
    several = contents.groupBy("anchor").agg(F.count("*").alias("n"), F.count_if(F.col("places") == 1).alias("once"))
    several = several.where("n > 1 AND once > 0").select("anchor", (F.col("n") > hot).alias("hot"))
    several = written(several, "several")
    asked = written(contents.join(several, "anchor").select(*content, "hot", "owner.*"), "asked")
    sums = asked.agg(
        F.sum(F.when(~F.col("hot"), F.col("windows") + (length - 1))).alias("size"), F.count_if("hot").alias("hot")
    ).first()
    shards = max(1, -(-(sums["size"] or 0) // SHARD))

    def brought(of: DataFrame, function, schema: str) -> DataFrame:
        # One text's segments are bounded by the text. ``doc`` comes along unread, so that
        # this exchange of texts is the one that ``removed`` needs, and is made once.
        lists = of.groupBy(*KEYS).agg(F.collect_list(F.struct(*content, "first", "windows")).alias("segments"))
        # Of equal rows one brings its bytes.
        one = F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.col("size"))) == 1
        met = rows.join(lists, KEYS).withColumn("one", one).where("one")
        return met.select("doc", "text", "segments").mapInArrow(function, schema)

    def parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
        """Segments of the texts with their bytes, some at a time."""
        texts, own = _bytes(batch.column("text")), batch.column("segments")
        of, every = pc.list_parent_indices(own), pa.RecordBatch.from_struct_array(own.flatten())
        for start in range(0, len(of), 2048):
            some = every.slice(start, 2048)
            places = (c.to_pylist() for c in (of.slice(start, 2048), some.column("first"), some.column("windows")))
            yield some, [texts[t][first : first + n + length - 1] for t, first, n in zip(*places)]

    def bring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, data in parts(batch):
                columns = [some.column(c) for c in (*content, "windows")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(data, pa.binary())], [*content, "windows", "data"])

    def sort(own: pa.Table) -> pa.Table:
        own = own.combine_chunks()
        anchor, hashed, windows = (own.column(c).to_numpy() for c in (*content, "windows"))
        joined = b"".join(own.column("data").to_pylist())
        sizes = windows + (length - 1)
        at = np.cumsum(sizes, dtype=np.int64) - sizes
        first, n = alike(joined, anchor, at, windows, length, gram)
        starts = np.cumsum(n + (length - 1)) - (n + (length - 1))
        parts = list(zip(starts.tolist(), first.tolist(), n.tolist()))
        valid, marks = np.zeros(int(n.sum()) + len(n) * (length - 1), bool), np.zeros(len(joined), bool)
        for start, _, count in parts:
            valid[start : start + count] = True
        view = memoryview(joined)
        bytes_of = b"".join([view[place : place + count + length - 1] for _, place, count in parts])
        found = suffixes.repeated(np.frombuffer(bytes_of, np.uint8), valid, length)
        for start, place, count in parts:
            marks[place : place + count] = found[start : start + count]
        # Between two contents' windows stand bytes that start none.
        spans = _spans(marks)
        row = np.searchsorted(at, spans[:, 0], "right") - 1
        having, offsets = np.unique(row, return_index=True)
        lists = pa.StructArray.from_arrays(
            [pa.array((spans[:, 0] - at[row]).astype(np.int32)), pa.array(spans[:, 1].astype(np.int32))], ["at", "n"]
        )
        lists = pa.ListArray.from_arrays(pa.array(np.append(offsets, len(row)).astype(np.int32)), lists)
        return pa.table([pa.array(anchor[having]), pa.array(hashed[having]), lists], [*content, "spans"])

    marked = "anchor long, content long, spans array<struct<at:int,n:int>>"
    by_shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    data = brought(asked.where("NOT hot"), bring, "anchor long, content long, windows int, data binary")
    found = data.select("*", by_shard).groupBy("shard").applyInArrow(sort, marked)
    if sums["hot"]:

        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for some, data in parts(batch):
                    for anchor, own, part in zip(*(some.column(c).to_pylist() for c in content), data):
                        n, width = len(part) - length + 1, 1 << (length.bit_length() - 1)
                        # A window is known by its first and its last bytes, which overlap.
                        halves = gram_hashes(np.frombuffer(part, np.uint8), width)
                        hashes = halves[:n] * np.uint64(_STEP) ^ halves[length - width :][:n]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([anchor] * n, pa.int64()),
                                pa.array([own] * n, pa.int64()),
                                pa.array(np.arange(n, dtype=np.int32)),
                                pa.array(hashes.view(np.int64)),
                            ],
                            [*content, "at", "hash"],
                        )

        windows = brought(asked.where("hot"), hashed, "anchor long, content long, at int, hash long")
        windows = written(windows.distinct(), "windows")
        twice = windows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
        of_hot = windows.join(twice, "hash", "left_semi").groupBy(*content).agg(
            F.collect_list(F.struct(F.col("at").alias("at"), F.lit(1).alias("n"))).alias("spans")
        )
        found = found.unionByName(of_hot)
    # Contents that stand twice are repeated as a whole; the others where another content has the same.
    whole = F.array(F.struct(F.lit(0).alias("at"), F.col("owner.windows").alias("n")))
    found = contents.where("places > 1").select(*content, whole.alias("spans")).unionByName(
        found.join(contents.where("places = 1").select(*content), content, "left_semi")
    )
    # A span of n windows covers n + length - 1 bytes; a run has its span at each of its places.
    covered = F.transform(
        "spans", lambda s: F.struct((F.col("first") + s["at"]).alias("at"), (s["n"] + F.col("run") + length - 2).alias("n"))
    )
    places = pool.join(found, content).select(*KEYS, covered.alias("spans"))
    return places.groupBy(*KEYS).agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _spans(marks: np.ndarray) -> np.ndarray:
    """Starts and sizes of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return np.column_stack([edges[::2], edges[1::2] - edges[::2]])


def kept_bytes(text: bytes, at: np.ndarray, n: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes outside of all spans, how many are inside and in how many runs."""
    if not len(at):
        return text, 0, 0
    order = np.argsort(at, kind="stable")
    at, ends = at[order], np.maximum.accumulate((at + n)[order])
    # A run begins behind the end of all spans before.
    head = np.flatnonzero(np.append(True, at[1:] > ends[:-1]))
    starts, ends = at[head].tolist(), ends[np.append(head[1:], len(at)) - 1].tolist()
    kept = b"".join([text[e:s] for e, s in zip([0, *ends], [*starts, len(text)])])
    return kept, len(text) - len(kept), len(starts)


def removed(
    docs: DataFrame,
    columns: list[str] | None = None,
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    hot: int = HOT,
    as_text: bool = False,
) -> DataFrame:
    """Each document's ``doc`` (``columns`` as a struct), ``n_bytes, n_removed, n_spans, kept``.

    ``kept`` are the remaining bytes, or as text what they spell without broken characters.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if columns is None else columns)])
    rows = docs.select(*_keys(docs, text), carried.alias("doc"), F.col(f"`{text}`").alias("text"))
    joined = rows.join(repeats(rows, length, gram, hot), KEYS, "left").select("doc", "text", "spans")
    kind = (T.StringType(), pa.string()) if as_text else (T.BinaryType(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = _bytes(batch.column("text")), batch.column("spans")
            spans = lists.flatten()
            at, n = (spans.field(c).to_numpy() for c in ("at", "n"))
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy()).tolist()
            found = [kept_bytes(t, at[s:e], n[s:e]) for t, s, e in zip(texts, [0, *ends], ends)]
            numbers = [[len(t) for t in texts], [f[1] for f in found], [f[2] for f in found]]
            kept = [f[0].decode("utf-8", "ignore") if as_text else f[0] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *(pa.array(x, pa.int64()) for x in numbers), pa.array(kept, kind[1])],
                ["doc", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    more = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    schema = T.StructType([joined.schema["doc"], *more, T.StructField("kept", kind[0])])
    return joined.mapInArrow(run, schema)


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """The documents with passages of ``length`` bytes that stand twice cut out of their texts."""
    rows = removed(docs, [c for c in docs.columns if c != text], text, length, as_text=True)
    return rows.select(*[(F.col("kept") if c == text else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
