"""Plain-Python answers on small inputs, straight from the definitions."""

from __future__ import annotations

import math
from collections import defaultdict


def distance(a, b):
    return math.sqrt((a[1] - b[1]) * (a[1] - b[1]) + (a[2] - b[2]) * (a[2] - b[2]))


def distance_x(a, b):
    return math.sqrt((a[1] - b[1]) * (a[1] - b[1]))


def pairs(r, s, exclude_self=True, dist=distance, group=None):
    for a in r:
        for b in s:
            if exclude_self and a[:3] == b[:3]:
                continue
            if group is not None and group(a) != group(b):
                continue
            yield a[0], b[0], dist(a, b)


def top_k(found, k, ties="distinct"):
    """{(src, dst, dist, rk)} of the k nearest; NaN sorts last."""
    by_source = defaultdict(set)
    for src, dst, d in found:
        by_source[src].add((math.isnan(d), 0.0 if math.isnan(d) else d, dst))
    out = set()
    for src, near in by_source.items():
        ordered = sorted(near)
        if ties == "distinct":
            smallest = {}
            for nan, d, dst in ordered:
                smallest.setdefault((nan, d), dst)
            ordered = [(nan, d, dst) for (nan, d), dst in smallest.items()]
        for rk, (nan, d, dst) in enumerate(ordered[:k], 1):
            out.add((src, dst, "NaN" if nan else d, rk))
    return out


def rows(df):
    """A result frame as a set of (src, dst, dist, rk)."""
    got = [(r["src"], r["dst"], "NaN" if math.isnan(r["dist"]) else r["dist"], r["rk"]) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)
