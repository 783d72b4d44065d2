"""Bounded-space online packing of token sequences.

Each partition keeps at most ``OPEN`` windows of ``WIDTH`` tokens. A piece goes
to the window it fits best; if none fits and no more may be opened, the fullest
is emitted. A gap of ``LEAST`` tokens or more in it is filled with the piece's
first tokens before, so that at most ``LEAST - 1`` tokens of it are padding. What is
open at the end of a partition is merged in rounds of ``FAN`` partitions each.

Defined results: null and empty texts have the end token alone; repeated rows
are packed each; an empty table gives an empty table. A document longer than a
window fills whole windows, its rest is a piece like any other.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.cut import written

WIDTH = 1024
OPEN = 64
LEAST = 16
FAN = 64
END = 0
#: A text with a longer run without blanks goes to the slower library, whose time does not grow with its square.
LONG_RUN = 10_000
#: So does one with a longer run of blanks, at which the faster library's pattern can also run out of stack.
LONG_BLANKS = 1_000
#: Rows that the packer gathers before it hands them on.
BATCH = 8192

PIECES = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(maxsize=2)
def _tokenizer(name: str):
    """A function from a text to ids: the vocabulary's byte-level BPE, two libraries with equal ids."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    special = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    long_blanks = re.compile(r"\s{%d}" % (LONG_BLANKS + 1))

    def ids(text: str) -> list[int]:
        if len(text) > LONG_BLANKS and long_blanks.search(text):
            return whole.encode(text, add_special_tokens=False).ids
        if len(text) > LONG_RUN and max(map(len, text.split())) > LONG_RUN:
            return whole.encode(text, add_special_tokens=False).ids
        return fast.encode(text, allowed_special="all")

    return ids


def token_ids(text: str | None, name: str = "byte_bpe_50k") -> np.ndarray:
    """The ids of a document with the end token."""
    return np.array([*_tokenizer(name)(text or ""), END], dtype="<u4")


class Packer:
    """Open windows of one partition; ``rows`` gathers the pieces of emitted sequences."""

    def __init__(self, prefix: int):
        self.sequence, self.rows = prefix, []
        self.windows: list[tuple[int, list[tuple]]] = []  # (filled, pieces), by filled

    def _emit(self, pieces: list[tuple], is_open: bool = False) -> None:
        offset = 0
        for doc_id, start, ids, tokens in pieces:
            kept = ids.tobytes()
            self.rows.append(
                (doc_id, start, len(ids), zlib.crc32(kept), tokens, self.sequence, offset, kept if is_open else None)
            )
            offset += len(ids)
        self.sequence += 1

    def _put(self, at: int, piece: tuple) -> None:
        filled, pieces = self.windows.pop(at) if at >= 0 else (0, [])
        filled += len(piece[2])
        pieces.append(piece)
        if filled == WIDTH:
            self._emit(pieces)
            return
        to = 0
        while to < len(self.windows) and self.windows[to][0] <= filled:
            to += 1
        self.windows.insert(to, (filled, pieces))

    def add(self, doc_id, start: int, ids: np.ndarray, tokens: int) -> None:
        """Place a document's ids; whole windows stand alone."""
        while len(ids) >= WIDTH:
            self._emit([(doc_id, start, ids[:WIDTH], tokens)])
            ids, start = ids[WIDTH:], start + WIDTH
        while len(ids):
            # The fullest window with room for all of it.
            fits = next((i for i in range(len(self.windows) - 1, -1, -1) if self.windows[i][0] + len(ids) <= WIDTH), None)
            if fits is not None or len(self.windows) < OPEN:
                self._put(-1 if fits is None else fits, (doc_id, start, ids, tokens))
                return
            gap = WIDTH - self.windows[-1][0]
            if gap >= LEAST:
                self._put(len(self.windows) - 1, (doc_id, start, ids[:gap], tokens))
                ids, start = ids[gap:], start + gap
            else:
                self._emit(self.windows.pop()[1])

    def close(self, is_open: bool) -> None:
        """Emit what is open; as open pieces with their ids if they are to be merged."""
        for _, pieces in self.windows:
            self._emit(pieces, is_open)
        self.windows = []

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _prefix(turn: int, part: int) -> int:
    """Sequence numbers: 4 bits of the round, 31 of the partition, 28 of the sequence."""
    return (turn << 59) | (part << 28)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    kind = docs.schema[doc_id].dataType.simpleString()
    columns = PIECES.format(kind).split(", ")
    names = [c.split()[0] for c in columns]
    schema = ", ".join([*columns, "ids binary", "part long"])
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def table(found: list[tuple], part: int, id_type: pa.DataType) -> pa.RecordBatch:
        arrays = list(zip(*found)) or [[]] * 8
        types = [id_type, *[pa.int64()] * 6, pa.binary()]
        made = [pa.array(a, t) for a, t in zip(arrays, types)]
        return pa.RecordBatch.from_arrays([*made, pa.array([part] * len(found), pa.int64())], [*names, "ids", "part"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer, id_type = Packer(_prefix(0, part)), None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for own_id, own_text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = token_ids(own_text.as_py(), vocabulary)
                packer.add(own_id, 0, ids, len(ids))
                if len(packer.rows) >= BATCH:
                    yield table(packer.taken(), part, id_type)
        if id_type is not None:
            packer.close(True)
            yield table(packer.taken(), part, id_type)

    def merge(turn: int, last: bool):
        def run(key: tuple, pieces: pa.Table) -> pa.Table:
            part = key[0].as_py()
            packer, id_type = Packer(_prefix(turn, part)), pieces.schema.field("doc_id").type
            # Large pieces first; the other columns make the order one of a kind.
            pieces = pieces.sort_by([("length", "descending"), ("sequence_id", "ascending"), ("offset", "ascending")])
            columns = [pieces.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")]
            for own_id, start, ids, tokens in zip(*columns):
                packer.add(own_id, start, np.frombuffer(ids, "<u4"), tokens)
            packer.close(not last)
            return pa.Table.from_batches([table(packer.taken(), part, id_type)])

        return run

    held = written(rows.mapInArrow(first, schema), "packed")
    done, open_rows = held.where("ids IS NULL"), held.where("ids IS NOT NULL")
    parts = (open_rows.agg(F.max("part")).first()[0] or 0) + 1
    turn = 1
    while True:
        last = parts <= FAN
        merged = open_rows.groupBy((F.col("part") / FAN).cast("long").alias("group")).applyInArrow(
            merge(turn, last), schema
        )
        if last:
            return done.unionByName(merged).select(*names)
        merged = written(merged, "packed")
        done, open_rows = done.unionByName(merged.where("ids IS NULL")), merged.where("ids IS NOT NULL")
        parts, turn = -(-parts // FAN), turn + 1
