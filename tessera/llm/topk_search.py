"""Exact top-k inner products by block-at-a-time pruning.

Vectors are rounded to integers and dealt, in the order of the signs of their
first components, into shards of blocks of ``BLOCK`` rows. A block keeps the
largest and the smallest value of each component (its term maxima for positive
and negative query weights) and its rows as a forward index. A query sums these
maxima into a bound per block, visits blocks by falling bound, scores their rows
and stops where the bound is below its k-th score. The k-th score in the query's
own shard is the threshold it starts with everywhere else.

Queries meet shards in blocks of both; no pair of single rows is a row.

Defined results: vectors that are null, or hold null or non-finite components,
take no part; shorter vectors count as filled with zeros; scores are exact, and a
rounded component or a score that leaves 64 bits is an error, never another number;
a null id is no query and sorts last among ties; repeated rows are rows of their
own; an empty table gives an empty table; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.plans.cut import written

BLOCK, SHARD = 64, 8192
#: Queries that meet a shard in one task.
QUERIES = 16_384
SCALE = 256.0
#: Integers below this are exact as doubles, so that their products can be sums of doubles.
EXACT = 2.0**53
NONE = np.iinfo(np.int64).min
LAST = np.iinfo(np.int64).max

SHARDS = (
    "shard long, dim int, width int, ids array<long>, vectors binary, "
    "q_rows array<int>, q_ids array<long>, q_least array<long>"
)


def _matrix(vectors: list) -> np.ndarray:
    """Rounded rows, shorter ones filled with zeros."""
    dim = max(map(len, vectors), default=0) or 1
    rows = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        rows[i, : len(v)] = v
    with np.errstate(over="ignore"):
        rows = np.floor(SCALE * rows)
    if np.abs(rows).max(initial=0) >= 2.0**63:
        raise OverflowError("a rounded vector component leaves 64 bits")
    return rows.astype(np.int64)


def _packed(rows: np.ndarray) -> tuple[int, bytes]:
    """Bytes of one integer, 4 where all fit and else 8, and the rows in them."""
    width = 4 if np.abs(rows).max(initial=0) < 2**31 else 8
    return width, rows.astype(f"<i{width}").tobytes()


def _unpacked(vectors: bytes, width: int, dim: int) -> np.ndarray:
    return np.frombuffer(vectors, f"<i{width}").reshape(-1, dim).astype(np.int64)


def _number_type(queries: np.ndarray, rows: np.ndarray) -> type:
    """The fastest type whose sums of products are exact for these integers."""
    most = queries.shape[1] * float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0))
    return np.float64 if most < EXACT else np.int64 if most < 2.0**62 else object


def _as_long(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object and not all(NONE <= x <= LAST for x in scores.flat):
        raise OverflowError("a score leaves 64 bits")
    return scores.astype(np.int64)


def _bounds(queries: np.ndarray, largest: np.ndarray, smallest: np.ndarray) -> np.ndarray:
    """The summed term maxima of each query and block, as doubles that are never too low."""
    above, below = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
    largest, smallest = largest.astype(float), smallest.astype(float)
    sizes = above @ np.abs(largest).T - below @ np.abs(smallest).T
    return above @ largest.T + below @ smallest.T + sizes * (queries.shape[1] + 4) * 2.0**-52


def _padded(rows: np.ndarray, dim: int) -> np.ndarray:
    return rows if rows.shape[1] == dim else np.pad(rows, ((0, 0), (0, dim - rows.shape[1])))


def search_shard(
    rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, least: np.ndarray, own: np.ndarray, k: int, block: int = BLOCK
) -> tuple[np.ndarray, np.ndarray, int]:
    """The best ``k`` scores and ids of each query in one shard, and how many (query, block) pairs were scored.

    ``least`` is a score that the k-th best of all is known to reach; ``own`` is
    the query's row in this shard, or -1. Missing places have the score ``NONE``.
    """
    dim = max(rows.shape[1], queries.shape[1])
    rows, queries = _padded(rows, dim), _padded(queries, dim)
    starts = np.arange(0, len(rows), block)
    largest, smallest = np.maximum.reduceat(rows, starts), np.minimum.reduceat(rows, starts)
    bounds = _bounds(queries, largest, smallest)
    kind = _number_type(queries, rows)
    queries, rows = queries.astype(kind), rows.astype(kind)
    order = np.argsort(-bounds, axis=1, kind="stable")
    scores = np.full((len(queries), k), NONE, np.int64)
    found = np.full((len(queries), k), LAST, np.int64)
    active, scored = np.arange(len(queries)), 0
    for turn in range(len(starts)):
        at = order[active, turn]
        going = bounds[active, at] >= np.maximum(least[active], scores[active, -1])
        active, at = active[going], at[going]
        if not len(active):
            break
        scored += len(active)
        for b in np.unique(at):
            who, first = active[at == b], starts[b]
            part = rows[first : first + block]
            got = queries[who] @ part.T
            here = own[who] - first
            mine = (here >= 0) & (here < len(part))
            got[np.flatnonzero(mine), here[mine]] = NONE
            all_scores = np.hstack([scores[who], _as_long(got)])
            all_ids = np.hstack([found[who], np.broadcast_to(ids[first : first + block], got.shape)])
            best = np.lexsort((all_ids, -np.maximum(all_scores, NONE + 1)), axis=1)[:, :k]
            scores[who] = np.take_along_axis(all_scores, best, 1)
            found[who] = np.take_along_axis(all_ids, best, 1)
    return scores, found, scored


def shards(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """One row per shard: ids (``LAST`` for null), rows, its queries and their k-th scores inside the shard."""
    v = F.col("v")
    usable = vectors.where(
        v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    )
    usable = usable.withColumn("q", F.coalesce(is_query, F.lit(False)))
    signs = F.aggregate(F.slice("v", 1, 16), F.lit(0), lambda a, x: 2 * a + F.when(x > 0, 1).otherwise(0))
    n = usable.count()
    dealt = usable.withColumn("signs", signs).repartitionByRange(max(1, -(-n // SHARD)), "signs", "id")

    def shard(number: int, ids: list, vectors: list, is_q: list) -> pa.RecordBatch:
        rows = _matrix(vectors)
        held = np.array([LAST if i is None else i for i in ids], np.int64)
        q = np.flatnonzero(np.array(is_q, bool))
        scores, _, _ = search_shard(rows, held, rows[q], np.full(len(q), NONE), q, k)
        width, packed = _packed(rows)
        values = [number, rows.shape[1], width, held.tolist(), packed, q.tolist(), [ids[i] for i in q], scores[:, -1].tolist()]
        types = [
            pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary(),
            pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()),
        ]
        names = [c.split()[0] for c in SHARDS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, is_q, number = [], [], [], TaskContext.get().partitionId() << 24
        for batch in batches:
            ids += batch.column("id").to_pylist()
            vectors += [x.values.to_numpy(zero_copy_only=False) for x in batch.column("v")]
            is_q += batch.column("q").to_pylist()
            while len(ids) >= 2 * SHARD:
                yield shard(number, ids[:SHARD], vectors[:SHARD], is_q[:SHARD])
                ids, vectors, is_q, number = ids[SHARD:], vectors[SHARD:], is_q[SHARD:], number + 1
        if ids:
            yield shard(number, ids, vectors, is_q)

    return written(dealt.select("id", "v", "q").mapInArrow(run, SHARDS), "search-shards")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows where ``is_query`` holds (in terms of ``id``).

    Candidates are all rows but the query's own.
    """
    index = shards(
        vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")),
        is_query,
        k,
    )
    n_queries = index.agg(F.sum(F.size("q_rows"))).first()[0] or 0
    chunks = max(1, -(-n_queries // QUERIES))
    # Whole blocks of queries go to every shard; the list of shards has a row for each SHARD rows.
    asked = index.where(F.size("q_rows") > 0).select(
        F.col("shard").alias("home"), "dim", "width", "vectors", "q_rows", "q_ids", "q_least",
        F.pmod(F.xxhash64("shard"), F.lit(chunks)).cast("int").alias("chunk"),
    )

    def only_queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["vectors"] = [
                _unpacked(v, w, d)[list(q)].astype(f"<i{w}").tobytes()
                for v, w, d, q in zip(batch["vectors"], batch["width"], batch["dim"], batch["q_rows"])
            ]
            yield batch

    asked = written(asked.mapInPandas(only_queries, asked.schema), "search-queries")
    asked = asked.crossJoin(F.broadcast(index.select(F.col("shard").alias("at"))))
    held = index.select("shard", "dim", "width", "ids", "vectors", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))

    def search(key: tuple, here: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        names = ["home", "row", "query_id", "vec_id", "score"]
        if here.empty or queries.empty:
            return pd.DataFrame({n: pd.Series(dtype="Int64") for n in names})
        own = here.iloc[0]
        unpack = lambda row: _unpacked(row["vectors"], row["width"], row["dim"])
        dim = int(queries["dim"].max())
        q = np.vstack([_padded(unpack(row), dim) for _, row in queries.iterrows()])
        q_rows, q_ids, least = (np.concatenate(queries[c].to_list()) for c in ("q_rows", "q_ids", "q_least"))
        home = np.repeat(queries["home"].to_numpy(), queries["q_rows"].map(len))
        ids = own["ids"].astype(np.int64)
        rows_own = np.where(home == own["shard"], q_rows, -1)
        scores, found, _ = search_shard(unpack(own), ids, q, least.astype(np.int64), rows_own, k)
        who, place = np.nonzero((scores != NONE) & (scores >= least[:, None]))
        got = pd.array(found[who, place], dtype="Int64")
        got[found[who, place] == LAST] = pd.NA
        return pd.DataFrame(
            {"home": home[who], "row": q_rows[who], "query_id": q_ids[who], "vec_id": got, "score": scores[who, place]}
        )

    near = held.groupBy("shard", "chunk").cogroup(asked.groupBy("at", "chunk")).applyInPandas(
        search, "home long, row int, query_id long, vec_id long, score long"
    )
    order = W.partitionBy("home", "row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = near.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
