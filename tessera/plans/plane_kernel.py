"""Nearest points of a block of tiles, found in one task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Candidates gathered before they are cut to the nearest.
AT_ONCE = 1 << 18


def _boxes(rows: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Smallest and largest value of each tile."""
    return {c: (np.minimum.reduceat(rows[c], starts), np.maximum.reduceat(rows[c], starts)) for c in ("g", "x", "y")}


def _cut(i: np.ndarray, j: np.ndarray, dist: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` smallest distinct distances of each source, each with the target of smallest ``order``."""
    sorting = np.lexsort((order[j], dist, i))
    i, j, dist = i[sorting], j[sorting], dist[sorting]
    new = np.append(True, (i[1:] != i[:-1]) | (dist[1:] != dist[:-1]))
    i, j, dist = i[new], j[new], dist[new]
    starts = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
    place = np.arange(len(i)) - np.repeat(starts, np.diff(np.append(starts, len(i))))
    return i[place < k], j[place < k], dist[place < k]


def nearest(
    sources: dict[str, np.ndarray], targets: dict[str, np.ndarray], order: np.ndarray, k: int, bits: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sources, targets and distances: the ``k`` smallest distinct ones within the source's bound.

    Columns ``rank, g, x, y``, and ``bound`` of sources; both sides stand in the order of their ranks.
    Tiles of ``1 << bits`` ranks meet the tiles whose box lies within their largest bound. Rows
    of equal rank are one place and do not meet.
    """
    none = np.empty(0, np.int64)
    if not len(sources["rank"]) or not len(targets["rank"]):
        return none, none, np.empty(0)
    first_s, first_t = (
        np.flatnonzero(np.append(True, np.diff(side["rank"] >> bits) != 0)) for side in (sources, targets)
    )
    last_s, last_t = np.append(first_s[1:], len(sources["rank"])), np.append(first_t[1:], len(targets["rank"]))
    own, other = _boxes(sources, first_s), _boxes(targets, first_t)
    reach = np.maximum.reduceat(sources["bound"], first_s)
    found, held, done = [], 0, []
    with np.errstate(over="ignore"):
        for tile, (start, end) in enumerate(zip(first_s, last_s)):
            dx, dy = (
                np.maximum(0.0, np.maximum(other[c][0] - own[c][1][tile], own[c][0][tile] - other[c][1]))
                for c in ("x", "y")
            )
            near = np.sqrt(dx * dx + dy * dy) <= reach[tile]
            near &= (other["g"][0] <= own["g"][1][tile]) & (other["g"][1] >= own["g"][0][tile])
            runs = np.flatnonzero(near)
            if not len(runs):
                continue
            index = np.concatenate([np.arange(first_t[t], last_t[t]) for t in runs])
            s = {c: v[start:end, None] for c, v in sources.items()}
            t = {c: v[index] for c, v in targets.items()}
            dx, dy = s["x"] - t["x"], s["y"] - t["y"]
            dist = np.sqrt(dx * dx + dy * dy)
            met = (dist <= s["bound"]) & (s["g"] == t["g"]) & (s["rank"] != t["rank"])
            i, j = np.nonzero(met)
            found.append((i + start, index[j], dist[i, j]))
            held += len(i)
            if held > AT_ONCE:
                done.append(_cut(*map(np.concatenate, zip(*found)), order, k))
                found, held = [], 0
    if held:
        done.append(_cut(*map(np.concatenate, zip(*found)), order, k))
    if not done:
        return none, none, np.empty(0)
    return tuple(map(np.concatenate, zip(*done)))


def search(k: int, bits: int, among: bool) -> Callable:
    """A cogrouped Arrow function: the sources of a block, each with its nearest in ``others``.

    Targets have ``rank, g, x, y, first``; ``among`` adds the sources to them.
    """

    def run(sources: pa.Table, targets: pa.Table) -> pa.Table:
        columns = ["rank", "g", "x", "y", "first"]
        targets = targets.select(columns)
        if among:
            targets = pa.concat_tables([sources.select(columns).cast(targets.schema), targets])
        sources = sources.take(pc.sort_indices(sources.column("rank")))
        targets = targets.take(pc.sort_indices(targets.column("rank")))

        def arrays(of: pa.Table, names: list[str]) -> dict[str, np.ndarray]:
            return {c: of.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in names}

        firsts = targets.column("first").combine_chunks()
        # A place whose ids are all null has none; it goes first, as in an ascending order.
        order = pc.rank(firsts, null_placement="at_start", tiebreaker="first").to_numpy().astype(np.int64)
        i, j, dist = nearest(
            arrays(sources, [*columns[:4], "bound"]), arrays(targets, columns[:4]), order, k, bits
        )
        ends = np.cumsum(np.bincount(i, minlength=sources.num_rows))
        offsets = pa.array(np.append(0, ends), pa.int32())
        lists = pa.ListArray.from_arrays(
            offsets, pa.StructArray.from_arrays([pa.array(dist), firsts.take(pa.array(j))], ["dist", "dst"])
        )
        return sources.select(["rank", "g", "x", "y", "r_ids"]).append_column("others", lists)

    return run
