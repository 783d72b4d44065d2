"""Upper bounds on the k-th neighbour distance from neighbours on the curve."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# Rows compared with each other: enough to hold k distinct distances, few
# enough to cost little.
SPAN = 64

# Covers a different order of summation than the one in the exact distance:
# distances closer than this may be equal there, so they count as one here.
SLACK = 1 + 1e-9

# Distances held at a time.
AT_ONCE = 1 << 22


def span_for(k: int) -> int:
    """Window length for ``k``: a power of two, at least four times ``k + 1``."""
    span = SPAN
    while span < 4 * (k + 1):
        span *= 2
    return span


def _kth_distinct(groups: np.ndarray, points: np.ndarray, k: int) -> np.ndarray:
    """k-th smallest distinct distance to another row, inside every window.

    ``groups`` is (windows, span), ``points`` is (windows, span, axes). Rows of
    other groups and the row itself do not count; infinite if too few are left.
    """
    windows, span, axes = points.shape
    found = np.empty((windows, span))
    block = max(1, AT_ONCE // (span * axes))
    at_once = max(1, block // span)
    for w in range(0, windows, at_once):
        own_groups, own = groups[w : w + at_once], points[w : w + at_once]
        for first in range(0, span, block):
            rows = slice(first, first + block)
            step = own[:, rows, None, :] - own[:, None, :, :]
            dist = np.sqrt((step * step).sum(axis=-1))
            dist[own_groups[:, rows, None] != own_groups[:, None, :]] = np.inf
            here = np.arange(first, min(first + block, span))
            dist[:, here - first, here] = np.inf
            dist.sort(axis=-1)
            new = np.ones(dist.shape, dtype=bool)
            new[:, :, 1:] = dist[:, :, 1:] > dist[:, :, :-1] * SLACK
            found[w : w + at_once, rows] = np.where(new.cumsum(axis=-1) == k, dist, np.inf).min(axis=-1)
    return found


def _starts(groups: np.ndarray, width: int) -> np.ndarray:
    """First rows of windows that cover all rows; a group is cut only if it is longer than a window."""
    n = len(groups)
    borders = np.append(np.flatnonzero(groups[1:] != groups[:-1]) + 1, n)
    starts, at = [], 0
    while True:
        end = at + width
        starts.append(min(at, n - width))
        if end >= n:
            return np.array(starts)
        last = int(np.searchsorted(borders, end, side="right"))
        begun = int(borders[last - 1]) if last else 0
        if begun > at:
            # The group that crosses the end starts the next window.
            at = begun
        else:
            # A long group: its last window is moved back so that it is full.
            left = int(borders[last]) - end
            at = end - width + left if 0 < left < width else end


def add_bound(k: int, axes: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that appends the column ``bound``.

    Rows come in curve order and at distinct places, so a window of consecutive
    rows holds places close to each other. Any set of targets gives a valid
    bound, so neither batch nor partition borders can make a result wrong. The
    end of a batch is kept as context for the next one.
    """
    span = span_for(k)

    def coordinates(batch: pa.RecordBatch) -> np.ndarray:
        if axes == ["v"]:
            vectors = batch.column("v")
            return np.asarray(vectors.flatten()).reshape(len(vectors), -1)
        return np.stack([np.asarray(batch.column(c)) for c in axes], axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_groups = last_points = None
        for batch in batches:
            if not batch.num_rows:
                continue
            groups, points = np.asarray(batch.column("g")), coordinates(batch)
            fresh = len(groups)
            if last_groups is not None:
                groups = np.concatenate([last_groups, groups])
                points = np.concatenate([last_points, points])
            context = len(groups) - fresh
            bound = np.empty(len(groups))
            width = min(span, len(groups))
            bound[:] = np.inf
            starts = _starts(groups, width)
            # As many windows at a time as keep the copied rows few.
            at_once = max(1, AT_ONCE // (width * points.shape[1]))
            for at in range(0, len(starts), at_once):
                rows = starts[at : at + at_once, None] + np.arange(width)
                # Windows may overlap; every one of them gives a valid bound.
                np.minimum.at(bound, rows.ravel(), _kth_distinct(groups[rows], points[rows], k).ravel())
            last_groups, last_points = groups[-span:], points[-span:]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bound[context:] * SLACK)],
                names=[*batch.schema.names, "bound"],
            )

    return run
