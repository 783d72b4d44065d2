"""Top-k search and packing against plain Python."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import packing, topk_search


def test_packed_ids_are_those_of_the_library(odd, sample):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r["text"] for d in (odd, sample) for r in d.select("text").collect()]
    texts += ["<|endoftext|> a <|endoftext|>", "tab\tand  blanks\n\n end ", "日本語 ١٢٣ ²", "a" * 12_000, "I'll we've 'S"]
    for text in texts:
        want = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert packing.token_ids(text).tolist() == want


def test_long_runs_of_blanks_are_packed():
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("word" + " " * 1_200_000 + "word", " \n\t" * 4000, "a" + "\u00a0" * 1001 + "b", ("a" + " " * 9000) * 20):
        assert packing.token_ids(text).tolist() == [*library.encode(text, add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("table", ["odd", "sample", "empty"])
def test_pieces_cover_every_document(request, table):
    docs = request.getfixturevalue(table)
    rows = packing.pack(docs).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WIDTH
    want = []
    for r in docs.select("doc_id", "text").collect():
        want.append((r["doc_id"] is None, r["doc_id"] or 0, packing.token_ids(r["text"])))
    total = sum(len(ids) for *_, ids in want)
    assert sum(r["length"] for r in rows) == total
    ids_of = {}
    for none, doc_id, ids in want:
        ids_of.setdefault((none, doc_id), []).append(ids)
    for r in rows:
        texts = ids_of[r["doc_id"] is None, r["doc_id"] or 0]
        crcs = [zlib.crc32(t[r["start"] : r["start"] + r["length"]].tobytes()) for t in texts if len(t) == r["doc_tokens"]]
        assert r["ids_crc32"] in crcs
    if total > 50_000:
        padding = sum(packing.WIDTH - sum(n for _, n in p) for p in sequences.values())
        assert padding < 0.02 * total


def test_leftovers_merge_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN", 2)
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 20).alias("text")).repartition(9)
    rows = packing.pack(docs).collect()
    assert sum(r["length"] for r in rows) == sum(r["doc_tokens"] for r in rows if r["start"] == 0)
    assert len({r["sequence_id"] for r in rows}) <= -(-sum(r["length"] for r in rows) // packing.WIDTH) + 1


def brute(rows, k):
    """Rows of (vec_id, vector) against all others."""
    usable = [(i, np.floor(256 * np.array(v))) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (qid, q) in enumerate(usable):
        if qid is not None and qid % 50 == 0:
            scored = []
            for b, (vid, v) in enumerate(usable):
                if a != b:
                    n = min(len(q), len(v))
                    scored.append((-int(q[:n] @ v[:n]), vid is None, vid))
            out += [(qid, r + 1, vid, -s) for r, (s, _, vid) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def searched(spark, rows, k=5):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk_search.top_k(frame, F.col("id") % 50 == 0, k).collect()
    return sorted((tuple(r) for r in found), key=repr)


def test_search_handles_odd_vectors(spark):
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (50, None), (100, [None, 1.0]), (150, [float("nan")]), (200, [float("inf"), 1.0])]
    rows += [(None, [0.25, 0.25]), (7, []), (8, [0.5]), (250, [0.1, -0.2, 0.3]), (9, [-1.0, 2.0])]
    assert searched(spark, rows) == brute(rows, 5)
    assert searched(spark, []) == []


@pytest.mark.parametrize("shard", [64, 300])
def test_search_over_many_shards_and_ties(spark, monkeypatch, shard):
    monkeypatch.setattr(topk_search, "SHARD", shard)
    monkeypatch.setattr(topk_search, "QUERIES", 7)
    rng = np.random.default_rng(3)
    values = rng.integers(-2, 3, (900, 8)) / 4
    values[300:600] = values[0]
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(values)]
    assert searched(spark, rows) == brute(rows, 5)


@pytest.mark.parametrize("size", [4.0, 2.0**21, 2.0**24])
def test_large_components_are_exact(spark, monkeypatch, size):
    monkeypatch.setattr(topk_search, "SHARD", 64)
    rng = np.random.default_rng(5)
    values = np.round(rng.normal(0, 1, (200, 3)) * [size / 4, 1, 1], 6)
    values[0], values[1] = [2e6, 1, 0], [3, 0, 0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
    whole = [[int(np.floor(256 * x)) for x in v] for _, v in rows]
    want = []
    for q in range(0, 200, 50):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in enumerate(whole) if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])]
    assert sum(a * b for a, b in zip(whole[0], whole[1])) == 393216000000
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk_search.top_k(frame, F.col("id") % 50 == 0).collect()
    assert sorted(tuple(r) for r in found) == sorted(want)


def test_scores_beyond_64_bits_are_errors():
    none, own = np.array([topk_search.NONE]), np.array([0])
    rows, ids = topk_search._matrix([[2.0**24], [2.0**20], [-1.0]]), np.arange(3)
    scores, found, _ = topk_search.search_shard(rows, ids, rows[:1], none, own, 2)
    assert scores.tolist() == [[2**60, -(2**40)]] and found.tolist() == [[1, 2]]
    with pytest.raises(OverflowError):
        topk_search.search_shard(rows, ids, rows[:1], none, np.array([-1]), 2)
    with pytest.raises(OverflowError):
        topk_search._matrix([[1e300]])
    scores, _, _ = topk_search.search_shard(topk_search._matrix([[], []]), ids[:2], np.zeros((1, 1), np.int64), none, own, 2)
    assert scores.tolist() == [[0, topk_search.NONE]]


def test_bounds_skip_blocks():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 200, (50, 16))
    rows = np.repeat(centres, 64, axis=0).astype(np.int64) + rng.integers(-5, 5, (3200, 16))
    ids, queries = np.arange(3200), rows[::100]
    least = np.full(len(queries), topk_search.NONE)
    scores, found, scored = topk_search.search_shard(rows, ids, queries, least, np.arange(0, 3200, 100), 5)
    exact = queries @ rows.T
    exact[np.arange(len(queries)), np.arange(0, 3200, 100)] = topk_search.NONE
    assert (np.sort(exact, axis=1)[:, ::-1][:, :5] == scores).all()
    assert scored < 0.2 * len(queries) * 50
