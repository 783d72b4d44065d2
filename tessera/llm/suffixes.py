"""Suffix order and common prefixes of one shard by external induced sorting.

Suffixes are L (larger than their successor) or S (smaller). Leftmost S suffixes
are sorted through the reduced string of their substrings' names, recursively.
Two scans then induce the rest: each scanned suffix puts its predecessor into the
queue of its first character, with the common prefix it has with the entry put
there before, which is one more than the least value scanned between them.

Entries reach a queue in order, so that a priority queue by (character, order) is
a run of blocks per character; blocks go to a file when more than ``memory``
entries are held. Only the text, types and runs of equal characters (some bytes a
position) stay in memory, the tuples do not.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Entries of all queues that are held in memory.
MEMORY = 1 << 20
#: Reduced strings up to this length are sorted in memory.
BASE = 1 << 22
_FAR = np.int64(1) << 40

Entries = tuple[np.ndarray, np.ndarray]


class Queue:
    """Entries (position, common prefix with the entry before) per character, in the order they came."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.held = memory, 0
        self.blocks: dict[int, list] = {}
        self.taken: dict[int, int] = {}
        self.file = None

    def put(self, char: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        self.blocks.setdefault(char, []).append((positions, prefixes))
        self.held += len(positions)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for blocks in self.blocks.values():
            for i, block in enumerate(blocks):
                if isinstance(block[0], np.ndarray):
                    at = self.file.tell()
                    self.file.write(np.stack(block).astype("<i8").tobytes())
                    blocks[i] = (at, len(block[0]))
        self.held = 0

    def _read(self, block: tuple) -> Entries:
        if isinstance(block[0], np.ndarray):
            return block
        self.file.seek(block[0])
        rows = np.frombuffer(self.file.read(16 * block[1]), "<i8").reshape(2, -1)
        return rows[0].copy(), rows[1].copy()

    def _joined(self, blocks: list) -> Entries:
        read = [self._read(b) for b in blocks]
        if not read:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([p for p, _ in read]), np.concatenate([x for _, x in read])

    def take(self, char: int) -> Entries:
        """The entries that came since the last call."""
        blocks, seen = self.blocks.get(char, []), self.taken.get(char, 0)
        self.taken[char] = len(blocks)
        return self._joined(blocks[seen:])

    def all(self, char: int) -> Entries:
        return self._joined(self.blocks.get(char, []))

    def close(self) -> None:
        self.blocks = {}
        if self.file is not None:
            self.file.close()


class Text:
    """A sequence of numbers below ``size``, with types and runs of equal characters."""

    def __init__(self, chars: np.ndarray):
        self.chars, self.n = chars, len(chars)
        self.size = int(chars.max(initial=0)) + 1
        self.chars = chars = chars.astype(np.uint8 if self.size <= 256 else np.int64)
        ends = np.flatnonzero(np.append(chars[:-1] != chars[1:], True))
        last = np.repeat(ends, np.diff(ends, prepend=-1))
        self.run = (last - np.arange(self.n) + 1).astype(np.int32)
        rises = np.append(chars[:-1] < chars[1:], False)
        self.is_s = rises[last]
        self.lms = np.flatnonzero(self.is_s[1:] & ~self.is_s[:-1]) + 1
        # The type of the position before; the first has none.
        self.before = np.append(np.int8(-1), self.is_s[:-1].view(np.int8))
        self._words = None

    def words(self) -> np.ndarray:
        """Eight characters from each position on as one number; bytes only. Past the end stand zeros."""
        if self._words is None:
            long = np.zeros(self.n + 8, np.uint64)
            long[: self.n] = self.chars
            found = np.zeros(self.n, np.uint64)
            for i in range(8):
                found <<= np.uint64(8)
                found |= long[i : i + self.n]
            self._words = np.append(found, np.uint64(0))
        return self._words

    def common(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Common prefixes of the suffixes at ``a`` and ``b``, cut at ``limit`` and the end."""
        limit = np.minimum(limit, self.n - np.maximum(a, b))
        found = np.zeros(len(a), np.int64)
        step = 8 if self.size <= 256 else 1
        source = self.words() if step == 8 else self.chars
        # Those still equal, by number, and where they are compared next.
        active = np.flatnonzero(limit > 0)
        a, b, left, done = a[active], b[active], limit[active], 0
        while len(active):
            x, y = source[a], source[b]
            equal = x == y
            if not equal.all():
                different = active[~equal]
                found[different] = done
                if step == 8:
                    x = (x ^ y)[~equal]
                    # The first byte that differs: leading zero bytes of the exclusive or.
                    for shift in range(56, 0, -8):
                        found[different] += x >> np.uint64(shift) == 0
            done += step
            ended = equal & (left <= done)
            found[active[ended]] = done
            on = equal & ~ended
            active, a, b, left = active[on], a[on] + step, b[on] + step, left[on]
        return np.minimum(found, limit)


def _scan(
    text: Text, queue: Queue, since: np.ndarray, positions: np.ndarray, prefixes: np.ndarray | None, s_type: bool
) -> None:
    """Put the predecessors of one type into their queues.

    ``since`` has, per character, the least prefix scanned since its last entry. Without
    ``prefixes`` there is the order only.
    """
    putting = np.flatnonzero(text.before[positions] == s_type)
    at = positions[putting] - 1
    chars = text.chars[at]
    # Few characters sort fast as short numbers.
    order = np.argsort(chars.astype(np.uint16) if 256 < text.size <= 1 << 16 else chars, kind="stable")
    chars, putting, at = chars[order], putting[order], at[order]
    n = len(chars)
    new = np.ones(n + 1, bool)
    new[1:-1] = chars[1:] != chars[:-1]
    bounds = np.flatnonzero(new)
    starts, ends = bounds[:-1], bounds[1:]
    heads = chars[starts]
    if prefixes is None:
        least = np.zeros(n, np.int64)
    else:
        padded = np.full(len(prefixes) + 1, _FAR)
        padded[:-1] = prefixes
        old = since[heads]
        np.minimum(since, padded.min(), out=since)
        if n:
            # From behind the last of the same character to this one.
            spans = np.zeros(2 * n, np.int64)
            spans[1::2] = putting + 1
            spans[2::2] = spans[1:-1:2]
            spans[2 * starts] = 0
            least = np.minimum.reduceat(padded, spans)[::2]
            least[starts] = np.minimum(least[starts], old)
            least += 1
            since[heads] = np.minimum.accumulate(padded[::-1])[::-1][putting[ends - 1] + 1]
    for char, start, end in zip(heads.tolist(), starts.tolist(), ends.tolist()):
        queue.put(char, at[start:end], least[start:end])


def induced(text: Text, seeds: np.ndarray, prefixes: np.ndarray | None, memory: int = MEMORY) -> Iterator[Entries]:
    """The suffixes from the last first character to the first: ascending positions' order within, with prefixes.

    ``seeds`` are the leftmost S suffixes in order, ``prefixes`` their common prefixes; without
    these there are none to go on, and zeros stand for the others'.
    """
    ordered = prefixes is None
    larger, smaller = Queue(memory), Queue(memory)
    present = np.unique(text.chars)
    since = np.full(text.size, -1, np.int64)
    cut = np.append(np.searchsorted(text.chars[seeds], present), len(seeds)).tolist()
    present = present.tolist()
    last = text.n - 1
    larger.put(int(text.chars[last]), np.array([last]), np.array([0]))
    since[text.chars[last]] = _FAR
    for char, start, end in zip(present, cut[:-1], cut[1:]):
        above = -1
        while len((entries := larger.take(char))[0]):
            positions, own = entries[0], entries[1].copy()
            if above < 0:
                own[0] = 0
            _scan(text, larger, since, positions, None if ordered else own, False)
            above = positions[-1]
        if end > start:
            own = None
            if not ordered:
                own = prefixes[start:end].copy()
                own[0] = min(text.run[above], text.run[seeds[start]]) if above >= 0 else 0
            _scan(text, larger, since, seeds[start:end], own, False)
    since[:] = -1
    for char in present[::-1]:
        below = -1
        while len((entries := smaller.take(char))[0]):
            positions, own = entries[0], entries[1].copy()
            if below < 0:
                own[0] = 0
            _scan(text, smaller, since, positions, None if ordered else own, True)
            below = positions[-1]
        first, first_prefixes = larger.all(char)
        second, second_prefixes = smaller.all(char)
        touch = min(text.run[first[-1]], text.run[below]) if len(first) and below >= 0 else 0
        if len(first):
            own = None if ordered else np.append(touch, first_prefixes[:0:-1])
            _scan(text, smaller, since, first[::-1], own, True)
            first_prefixes = first_prefixes.copy()
            first_prefixes[0] = 0
        # An S entry's value is that with the larger one put before it.
        second_prefixes = np.append(second_prefixes[1:], touch)[::-1] if len(second) else second_prefixes
        yield np.append(first, second[::-1]), np.append(first_prefixes, second_prefixes)
    larger.close()
    smaller.close()


def doubled(names: np.ndarray, reach: int) -> np.ndarray:
    """The suffixes of ``names`` in order of their first ``reach`` names, in memory."""
    rank, step, n = names.astype(np.int64), 1, len(names)
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key)
        key = key[order]
        new = np.append(0, np.cumsum(key[1:] != key[:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or step >= min(reach, n):
            return order


def sorted_lms(text: Text, reach: int, memory: int = MEMORY, base: int = BASE) -> np.ndarray:
    """The leftmost S suffixes in order of at least their first ``reach`` characters."""
    lms = text.lms
    if len(lms) < 2:
        return lms
    by_char = lms[np.argsort(text.chars[lms], kind="stable")]
    is_lms = np.zeros(text.n, bool)
    is_lms[lms] = True
    parts = [p[is_lms[p]] for p, _ in induced(text, by_char, None, memory)]
    order = np.concatenate(parts[::-1])
    # Equal substrings get equal names; the last one ends with the text and is unlike any other.
    length = np.diff(np.append(lms, text.n)) + 1
    number = np.zeros(text.n, np.int64)
    number[lms] = np.arange(len(lms))
    size = length[number[order]]
    a, b = order[:-1], order[1:]
    same = (size[:-1] == size[1:]) & (a != lms[-1]) & (b != lms[-1])
    equal = np.zeros(len(a), bool)
    equal[same] = text.common(a[same], b[same], size[:-1][same]) == size[:-1][same]
    name = np.append(0, np.cumsum(~equal))
    names = np.empty(len(lms), np.int64)
    names[number[order]] = name
    if name[-1] == len(lms) - 1:
        return order
    # A name stands for two characters or more.
    reach = reach // 2 + 1
    if len(names) <= base:
        return lms[doubled(names, reach)]
    below = Text(names)
    seeds = sorted_lms(below, reach, memory, base)
    found = [p for p, _ in induced(below, seeds, None, memory)]
    return lms[np.concatenate(found[::-1])]


def neighbours(text: Text, order: np.ndarray, reach: int) -> np.ndarray:
    """The common prefix of each suffix in ``order`` with the one before, exact below ``reach``.

    Where the next suffix of the text stands behind the same shift of itself, as in a copy, only
    the characters up to it are compared: the rest is its own prefix.
    """
    prefixes = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return prefixes
    rank = np.argsort(order)
    rank = rank[rank > 0]
    a, b = order[rank], order[rank - 1]
    gap = np.append(np.diff(a), reach)
    along = np.append((a - b)[1:] == (a - b)[:-1], False) & (gap < reach)
    own = text.common(a, b, np.where(along, gap, reach))
    # The first suffix from each on whose prefix ends before the next.
    stops = np.flatnonzero(~(along & (own == gap)))
    stop = stops[np.searchsorted(stops, np.arange(len(a)))]
    prefixes[rank] = np.minimum(a[stop] - a + own[stop], reach)
    return prefixes


def suffixes(chars: np.ndarray, reach: int, memory: int = MEMORY, base: int = BASE) -> Iterator[Entries]:
    """Suffixes with common prefixes, by falling first character; prefixes are exact below ``reach``."""
    if not len(chars):
        return
    text = Text(chars)
    seeds = sorted_lms(text, reach, memory, base)
    yield from induced(text, seeds, neighbours(text, seeds, reach), memory)


def repeated(chars: np.ndarray, valid: np.ndarray, length: int, memory: int = MEMORY, base: int = BASE) -> np.ndarray:
    """Which valid positions start a string of ``length`` that another valid position starts too."""
    found = np.zeros(len(chars), bool)
    for positions, prefixes in suffixes(chars, length, memory, base):
        group = np.cumsum(prefixes < length)
        own = valid[positions]
        n = np.bincount(group[own], minlength=int(group[-1]) + 1)
        found[positions[own & (n[group] > 1)]] = True
    return found
