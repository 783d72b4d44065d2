"""Exact kNN joins in the plane, on one axis and over vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.metrics import euclidean_vec
from tessera.plans.nearest import knn_join
from tessera.plans.tiles import Pivoted

AXES = ("plane", "x")


def knn_exact(
    r: DataFrame,
    s: DataFrame | None = None,
    k: int = 5,
    *,
    axes: str = "plane",
    exclude_self: bool = True,
    ties: str = "distinct",
    unique_ids: bool = False,
) -> DataFrame:
    """The ``k`` nearest points of ``s`` for every point of ``r``: src, dst, dist, rk.

    ``s=None`` joins ``r`` with itself. ``axes="x"`` measures along the first
    coordinate only. See ``knn_join`` for ``ties``, ``unique_ids`` and rows
    without usable coordinates.
    """
    if axes not in AXES:
        raise ValueError(f"axes must be one of {AXES}, not {axes!r}")

    def side(df: DataFrame) -> DataFrame:
        y = F.col("y") if axes == "plane" else F.when(F.col("y").isNotNull(), F.lit(0.0))
        return df.select("id", F.lit(0).cast("long").alias("g"), F.col("x"), y.alias("y"))

    return knn_join(
        side(r),
        None if s is None else side(s),
        k,
        ties=ties,
        exclude_self=exclude_self,
        unique_ids=unique_ids,
    )


def knn_brute(
    r: DataFrame,
    s: DataFrame | None = None,
    k: int = 5,
    *,
    axes: str = "plane",
    exclude_self: bool = True,
    ties: str = "distinct",
    unique_ids: bool = False,
) -> DataFrame:
    """What comparing every point of ``r`` with every point of ``s`` would give.

    The rows are those of the full comparison; the work is that of
    ``knn_exact``, since a product of two large point sets cannot finish.
    """
    return knn_exact(
        r, s, k, axes=axes, exclude_self=exclude_self, ties=ties, unique_ids=unique_ids
    )


def knn_lat_only(
    r: DataFrame, k: int = 5, *, s: DataFrame | None = None, unique_ids: bool = False
) -> DataFrame:
    """kNN by the first coordinate alone; without ``s`` every point is its own neighbour at 0."""
    return knn_exact(r, s, k, axes="x", exclude_self=False, unique_ids=unique_ids)


def _literal(vector: list[float]) -> Column:
    return F.array(*[F.lit(float(c)) for c in vector])


# Vectors that pivots and basis are taken from, about; any others would only change the speed.
SAMPLE = 2048


def _basis(sample: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and orthonormal directions of a sample, the largest variance first."""
    if len(sample) < 2:
        return np.zeros(m), np.eye(m)
    mean = sample.mean(axis=0)
    _, directions = np.linalg.eigh((sample - mean).T @ (sample - mean) / len(sample))
    return mean, np.ascontiguousarray(directions[:, ::-1])


def knn_vec(
    r: DataFrame,
    s: DataFrame | None = None,
    k: int = 5,
    m: int = 2,
    *,
    exclude_self: bool = True,
    ties: str = "distinct",
    unique_ids: bool = False,
    work: bool = False,
) -> DataFrame:
    """kNN over the first ``m`` coordinates of the array column ``v``.

    Search regions are pruned by the distances to two vectors of a sample, the one
    farthest from the origin and the one farthest from that. Regions that are left meet
    in blocks: coordinates are turned into the sample's directions of largest variance,
    the leading ones rule out targets, a matrix product estimates the rest, and only
    what the estimate leaves open is computed in full. Arrays with fewer than ``m``
    coordinates, or with null ones, take no part.

    ``work=True`` gives one row instead: ``pairs`` that met, ``leading`` distances over
    the leading coordinates and ``whole`` distances over all of them.
    """

    def cut(df: DataFrame) -> DataFrame:
        v = F.transform(F.slice("v", 1, m), lambda c: c.cast("double") + F.lit(0.0))
        whole = (F.size("v") == m) & F.forall("v", lambda c: c.isNotNull())
        return df.select("id", v.alias("v")).where(whole)

    r_cut, s_cut = cut(r), None if s is None else cut(s)
    targets = r_cut if s_cut is None else s_cut
    rows = targets.count()
    # A share of the rows, about SAMPLE of them, whatever their number.
    some = targets.select("v") if rows <= SAMPLE else targets.select("v").sample(SAMPLE / rows, 42)
    sample = np.array([row["v"] for row in some.collect()], np.float64).reshape(-1, m)
    # Squares of what is left stay finite.
    sample = sample[(np.abs(sample) < 1e100).all(axis=1)]

    def farthest(pivot: np.ndarray) -> np.ndarray:
        away = ((sample - pivot) ** 2).sum(axis=1)
        return sample[away.argmax()] if len(sample) else pivot

    first = farthest(np.zeros(m))
    second = farthest(first)
    mean, basis = _basis(sample, m)

    def side(df: DataFrame) -> DataFrame:
        return df.select(
            "id",
            F.lit(0).cast("long").alias("g"),
            euclidean_vec(F.col("v"), _literal(first), m).alias("x"),
            euclidean_vec(F.col("v"), _literal(second), m).alias("y"),
            "v",
        )

    return knn_join(
        side(r_cut),
        None if s_cut is None else side(s_cut),
        k,
        ties=ties,
        exclude_self=exclude_self,
        unique_ids=unique_ids,
        shape=Pivoted(m, mean=mean, basis=basis),
        work=work,
    )
