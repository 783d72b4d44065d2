"""Nearest-neighbour analytics over large point sets, on Spark DataFrames."""

from tessera.functions.cells import grid_cell, ring_id, ring_key
from tessera.functions.metrics import euclidean, euclidean_vec
from tessera.operators.dedup import dedup_last
from tessera.operators.grid import bounding_box, grid_cells, grid_histogram
from tessera.operators.index import PointIndex, blocks_reached, build_index, open_index, radius_search
from tessera.operators.knn import knn_brute, knn_exact, knn_lat_only, knn_vec
from tessera.operators.radius import expand_places, radius_join, radius_join_capped, radius_places
from tessera.operators.rings import knn_ring, point_stats, ring_assign, ring_replicas
from tessera.operators.topk import neighbour_lists, top_k
from tessera.operators.upsample import upsample
from tessera.plans.cut import Tables, release
from tessera.sources.points import parse_points, point_lines, read_points, write_points
from tessera.sources.sinks import neighbour_report, write_neighbours, write_report

__all__ = [
    "PointIndex",
    "Tables",
    "blocks_reached",
    "bounding_box",
    "build_index",
    "dedup_last",
    "euclidean",
    "euclidean_vec",
    "expand_places",
    "grid_cell",
    "grid_cells",
    "grid_histogram",
    "knn_brute",
    "knn_exact",
    "knn_lat_only",
    "knn_ring",
    "knn_vec",
    "neighbour_lists",
    "neighbour_report",
    "open_index",
    "parse_points",
    "point_lines",
    "point_stats",
    "radius_join",
    "radius_join_capped",
    "radius_places",
    "radius_search",
    "read_points",
    "release",
    "ring_assign",
    "ring_id",
    "ring_key",
    "ring_replicas",
    "top_k",
    "upsample",
    "write_neighbours",
    "write_points",
    "write_report",
]
