"""Distances of a block of vectors from many others, few of them computed in full."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Sources and targets compared at a time.
SOURCES = 128
AT_ONCE = 4096

# Distances closer than this may be equal in another order of summation.
SLACK = 1 + 1e-9


def vectors(column: pa.ChunkedArray | pa.Array, m: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), m)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances row by row, squares added in the order of the coordinates."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        step = a[:, i] - b[:, i]
        total += step * step
    return np.sqrt(total)


def _kth(squares: np.ndarray, error: np.ndarray, k: int, distinct: bool) -> np.ndarray:
    """An upper bound on the k-th smallest (distinct) square of each row; infinite if there are fewer."""
    bound = np.full(len(squares), np.inf)
    high = squares + error
    if not distinct:
        if high.shape[1] >= k:
            bound = np.partition(high, k - 1, axis=1)[:, k - 1]
        return np.where(np.isnan(bound), np.inf, bound)
    todo = np.arange(len(squares))
    width = min(high.shape[1], 8 * k)
    while len(todo):
        least = np.partition(high[todo], width - 1, axis=1)[:, :width] if width < high.shape[1] else high[todo].copy()
        least.sort(axis=1)
        new = np.ones(least.shape, bool)
        new[:, 1:] = least[:, 1:] > least[:, :-1] * SLACK * SLACK + 4 * error[todo].max(axis=1, keepdims=True)
        at = np.where((new.cumsum(axis=1) == k) & np.isfinite(least), least, np.inf).min(axis=1)
        bound[todo] = at
        if width == high.shape[1]:
            break
        # Many equal squares: look farther.
        todo, width = todo[np.isinf(at)], min(high.shape[1], 8 * width)
    return bound


def _reduced(
    i: np.ndarray, j: np.ndarray, dist: np.ndarray, order: np.ndarray, k: int, distinct: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest of each source, by distance and ``order``, and the place of each among them."""
    sorting = np.lexsort((order[j], dist, i))
    i, j, dist = i[sorting], j[sorting], dist[sorting]
    if distinct and len(i):
        new = np.append(True, (i[1:] != i[:-1]) | (dist[1:] != dist[:-1]))
        i, j, dist = i[new], j[new], dist[new]
    starts = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.empty(0, np.int64)
    place = np.arange(len(i)) - np.repeat(starts, np.diff(np.append(starts, len(i))))
    kept = place < k
    return i[kept], j[kept], dist[kept], place[kept]


def nearest(
    source: np.ndarray,
    ranks: np.ndarray,
    bounds: np.ndarray,
    target: np.ndarray,
    target_ranks: np.ndarray,
    order: np.ndarray,
    k: int,
    distinct: bool,
    mean: np.ndarray,
    basis: np.ndarray,
    pivots: tuple[np.ndarray, np.ndarray, float] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """Sources, targets and distances that hold the ``k`` nearest of each source, within its bound.

    Rows of equal rank are one place and do not meet. Of equal distances the target
    with the smallest ``order`` counts; ``distinct`` keeps one of each distance.

    ``SOURCES`` rows at a time meet the targets that ``pivots`` leave: distances of
    sources and of targets to fixed vectors, and the slack that covers their rounding.
    Coordinates are turned into ``basis``, largest variance first, so that the leading
    ones rule out most targets that are far away. What is left is estimated by a matrix
    product, and only what the estimate's error leaves open is computed in full, in the
    order that defines the result. At most ``k`` rows of a source are kept between the
    pieces, and the ``k``-th is its new bound. Also returns how many leading and full
    distances were computed.
    """
    turned, norms = np.empty(target.shape), np.empty(len(target))
    with np.errstate(over="ignore", invalid="ignore"):
        for at in range(0, len(target), AT_ONCE):
            piece = slice(at, at + AT_ONCE)
            turned[piece] = (target[piece] - mean) @ basis
            norms[piece] = (turned[piece] * turned[piece]).sum(axis=1)
    found, partial, full = [], 0, 0
    for first in range(0, len(source), SOURCES):
        own = slice(first, first + SOURCES)
        index = np.arange(len(target))
        if pivots is not None:
            p, q, slack = pivots
            reach = bounds[own].max() * SLACK + slack
            near = (q >= p[own].min(axis=0) - reach) & (q <= p[own].max(axis=0) + reach)
            index = np.flatnonzero(near.all(axis=1))
        i, j, dist, leading, whole = _block(
            source[own], ranks[own], bounds[own], target, target_ranks, index, turned, norms, order, k, distinct, mean, basis
        )
        found.append((i + first, j, dist))
        partial += leading
        full += whole
    if not found:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0), partial, full
    return *(np.concatenate(c) for c in zip(*found)), partial, full


def _block(
    source: np.ndarray,
    ranks: np.ndarray,
    bounds: np.ndarray,
    target: np.ndarray,
    target_ranks: np.ndarray,
    index: np.ndarray,
    turned: np.ndarray,
    norms: np.ndarray,
    order: np.ndarray,
    k: int,
    distinct: bool,
    mean: np.ndarray,
    basis: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """``nearest`` for few sources and the targets at ``index``."""
    m = source.shape[1]
    lead = m if m <= 8 else max(4, m // 4)
    eps = np.finfo(np.float64).eps * 16 * (m + 4)
    none = np.empty(0, np.int64)
    rows, columns, dists, partial, full = none, none, np.empty(0), 0, 0
    bounds = bounds.copy()
    with np.errstate(over="ignore", invalid="ignore"):
        s = (source - mean) @ basis
        s_norm = (s * s).sum(axis=1)
        for first in range(0, len(index), AT_ONCE):
            cut = index[first : first + AT_ONCE]
            partial += len(s) * len(cut)

            def squares(of: slice, cut: np.ndarray) -> np.ndarray:
                a, b = s[:, of], turned[cut][:, of]
                return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)

            limit = (bounds * SLACK) ** 2
            found = squares(slice(0, lead), cut)
            if lead < m:
                error = eps * (s_norm[:, None] + norms[None, cut])
                # Comparisons are turned round, so that overflowed values stay in.
                left = np.flatnonzero(~(found - error > limit[:, None]).all(axis=0))
                if not len(left):
                    continue
                cut = cut[left]
                found = found[:, left] + squares(slice(lead, m), cut)
            error = eps * (s_norm[:, None] + norms[None, cut])
            same = ranks[:, None] == target_ranks[cut][None, :]
            found[same] = np.inf
            inside = ~(found - error > limit[:, None]) & ~same
            # Only a source with k targets or more within its bound gets a smaller bound here.
            many = np.flatnonzero(inside.sum(axis=1) >= k)
            if len(many):
                limit[many] = np.minimum(limit[many], _kth(found[many], error[many], k, distinct) * SLACK * SLACK)
                inside[many] &= ~(found[many] - error[many] > limit[many, None])
            i, j = np.nonzero(inside)
            j = cut[j]
            full += len(i)
            new = [(rows, columns, dists)]
            for at in range(0, len(i), 1 << 18):
                own_i, own_j = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
                dist = exact(source[own_i], target[own_j])
                within = dist <= bounds[own_i]
                new.append((own_i[within], own_j[within], dist[within]))
            rows, columns, dists, place = _reduced(*(np.concatenate(c) for c in zip(*new)), order, k, distinct)
            last = place == k - 1
            bounds[rows[last]] = np.minimum(bounds[rows[last]], dists[last])
    return rows, columns, dists, partial, full


def search(
    k: int, distinct: bool, mean: np.ndarray, basis: np.ndarray, slack: float, count: bool = False
) -> Callable:
    """A cogrouped Arrow function: sources of a block and targets to the nearest of each source.

    Gives ``q_rank, t_s_ids, dist``, or with ``count`` the numbers of pairs that met,
    of leading and of full distances.
    """

    def run(sources: pa.Table, targets: pa.Table) -> pa.Table:
        m = len(mean)
        ids = targets.column("s_ids").combine_chunks()
        # Lists hold an id at least; ranks order ids of any kind.
        firsts = pc.list_element(ids, 0)
        order = np.asarray(pc.rank(firsts, tiebreaker="first")).astype(np.int64) if len(firsts) else np.empty(0, np.int64)
        ranks = np.asarray(sources.column("rank").combine_chunks())

        def pivots(of: pa.Table) -> np.ndarray:
            return np.stack([np.asarray(of.column(c).combine_chunks()) for c in ("x", "y")], axis=1)

        i, j, dist, partial, full = nearest(
            vectors(sources.column("v"), m),
            ranks,
            np.asarray(sources.column("bound").combine_chunks()),
            vectors(targets.column("v"), m),
            np.asarray(targets.column("rank").combine_chunks()),
            order,
            k,
            distinct,
            mean,
            basis,
            (pivots(sources), pivots(targets), slack),
        )
        if count:
            numbers = [len(ranks) * targets.num_rows, partial, full]
            return pa.table({n: pa.array([x], pa.int64()) for n, x in zip(("pairs", "leading", "whole"), numbers)})
        return pa.table({"q_rank": pa.array(ranks[i]), "t_s_ids": ids.take(pa.array(j)), "dist": pa.array(dist)})

    return run
