"""SimHash near-duplicates, suffix order and repeated passages against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash, suffix_dedup, suffixes


def plain_fingerprint(text):
    w = (text or "").encode().translate(simhash._LOWER).split()
    grams = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, bits=4):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    every = sorted(parent)
    for i, a in enumerate(every):
        for b in every[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    return {f: find(f) for f in every}


@pytest.mark.parametrize("table", ["odd", "sample", "empty"])
def test_groups(request, table):
    docs = request.getfixturevalue(table)
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.select("doc_id", "text").collect()]
    root = plain_components({f for _, f in rows})
    least = {}
    for i, f in rows:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = Counter((i, f, least.get(root[f])) for i, f in rows)
    got = Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert got == want
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root.values()))


def test_hex_has_sixteen_digits(spark):
    frame = spark.createDataFrame([(0,), (-1,), (255,)], "fp long")
    digits = frame.select(F.lpad(F.lower(F.hex("fp")), 16, "0")).collect()
    assert [r[0] for r in digits] == ["0" * 16, "f" * 16, "0" * 14 + "ff"]


@pytest.mark.parametrize("chunk", [8, 4096])
def test_links_lose_no_component(spark, monkeypatch, chunk):
    """Chains of near fingerprints, dense balls and random ones; small chunks split every anchor."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = random.Random(chunk)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for start in [rng.getrandbits(64) for _ in range(6)]:
        x = start
        for _ in range(15):
            for bit in rng.sample(range(64), 4):
                x ^= 1 << bit
            fps.add(x)
        fps |= {start ^ (1 << a) ^ (1 << b) for a, b in (rng.sample(range(64), 2) for _ in range(25))}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    classes = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {r["node"]: r["root"] for r in simhash.components(simhash.links(classes)).collect()}
    want = plain_components(fps)
    groups_of = lambda pairs: {frozenset(g) for g in pairs.values()}
    got, expected = {}, {}
    for f, s in zip(fps, signed):
        got.setdefault(found.get(s, s), set()).add(f)
        expected.setdefault(want[f], set()).add(f)
    assert groups_of(got) == groups_of(expected)


def test_anchors_cover_every_block():
    for _, width in simhash.BLOCKS:
        patterns = simhash._patterns(width)
        values = np.random.default_rng(0).integers(0, 1 << width, 200)
        for v, s in zip(values, simhash._syndromes(values)):
            home = int(v) ^ int(patterns[s][0])
            assert simhash._syndromes(np.array([home]))[0] == 0 and (home ^ int(v)).bit_count() <= 1
            for bit in range(width):
                u = np.array([int(v) ^ (1 << bit)])
                assert home in (u[0] ^ patterns[simhash._syndromes(u)[0]])


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1500)]
    found = simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["root"] for r in found} == {0, 1000} and len(found) == 301 + 500


def test_suffix_order():
    rng = np.random.default_rng(0)
    for _ in range(150):
        text = rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(1, 60)))
        raw = text.astype(np.uint8).tobytes()
        want = sorted(range(len(raw)), key=lambda i: raw[i:])
        common = lambda a, b: next((k for k in range(len(raw)) if raw[a + k : a + k + 1] != raw[b + k : b + k + 1]), 0)
        # Small limits force queues to disk and the recursion to its second level.
        for memory, base in ((1 << 20, 1 << 20), (5, 2)):
            found = list(suffixes.suffixes(text.astype(np.int64), 1000, memory, base))[::-1]
            assert np.concatenate([p for p, _ in found]).tolist() == want
            prefixes = np.concatenate([x for _, x in found]).tolist()
            assert prefixes == [0] + [common(a, b) for a, b in zip(want, want[1:])]


@pytest.mark.parametrize("reach", [7, 40, 1000])
def test_prefixes_along_copies(reach):
    rng = random.Random(reach)
    passage = bytes(rng.choices(b"abcd", k=90))
    raw = b"".join(bytes(rng.choices(b"abcd", k=rng.randint(1, 9))) + passage[rng.randint(0, 30) :] for _ in range(12))
    text = suffixes.Text(np.frombuffer(raw, np.uint8))
    order = sorted(text.lms.tolist(), key=lambda i: raw[i:])
    found = suffixes.neighbours(text, np.array(order), reach)
    common = lambda a, b: next((k for k in range(reach) if raw[a + k : a + k + 1] != raw[b + k : b + k + 1]), reach)
    assert found.tolist() == [0] + [common(a, b) for a, b in zip(order, order[1:])]


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = Counter()
    for (doc_id, _), t in zip(rows, texts):
        inside = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                inside[i : i + length] = True
        kept = np.frombuffer(t, np.uint8)[~inside].tobytes()
        spans = int((np.diff(np.append(0, inside.astype(int))) == 1).sum())
        out[doc_id, len(t), int(inside.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def cut(docs, **more):
    found = suffix_dedup.removed(docs, ["doc_id"], **more).select("doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    return Counter((*r[:4], hashlib.sha256(bytes(r[4])).hexdigest()) for r in found.collect())


@pytest.mark.parametrize("table", ["odd", "sample", "empty"])
def test_removed_bytes(request, table):
    docs = request.getfixturevalue(table)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    # The long texts stand twice as whole rows, so that plain code may skip their insides.
    assert cut(docs) == brute(rows, 400)


@pytest.mark.parametrize("hot", [0, 2048])
def test_shared_passages_in_both_ways(documents, monkeypatch, hot):
    """Passages across edges of all kinds; with ``hot=0`` every contested window is counted one by one."""
    monkeypatch.setattr(suffix_dedup, "SHARD", 5_000)
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdéf", k=rng.randint(1, 6))) for _ in range(60)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passages = [text(40) for _ in range(4)]
    rows = [(i, " ".join(x for _ in range(3) for x in (text(rng.randint(0, 40)), rng.choice(passages)))) for i in range(40)]
    rows += [(100, "ab" * 300), (101, "x" * 200), (102, "x" * 90 + "y" + "x" * 64), (103, rows[0][1]), (104, rows[0][1][3:-5])]
    docs = documents([(i, t, "s") for i, t in rows])
    assert cut(docs, length=64, gram=16, hot=hot) == brute(rows, 64)


@pytest.mark.parametrize("length, gram", [(64, 16), (61, 8), (64, 32)])
def test_windows_that_stand_once_are_not_sorted(length, gram):
    """Short phrases that many texts share, and few long passages: all their windows are kept, most others go."""
    rng = random.Random(length)
    text = lambda n: bytes(rng.choices(b"abcdefgh", k=n))
    phrases, passages = [text(gram + 8) for _ in range(6)], [text(2 * length) for _ in range(3)]
    texts = [b"".join(text(rng.randint(20, 60)) + rng.choice(phrases) for _ in range(8)) for _ in range(150)]
    texts += [text(50) + rng.choice(passages)[rng.randint(0, 9) :] + text(50) for _ in range(20)]
    sizes = np.array([len(t) for t in texts])
    anchors, of, first, n = suffix_dedup.cut(np.frombuffer(b"".join(texts), np.uint8), sizes, length, gram)
    contents = sorted({(a, texts[t][f : f + w + length - 1]) for a, t, f, w in zip(*(c.tolist() for c in (anchors, of, first, n)))})
    anchor, data = np.array([a for a, _ in contents]), [d for _, d in contents]
    sizes = np.array([len(d) for d in data])
    at, joined = np.cumsum(sizes) - sizes, b"".join(data)
    starts, counts = suffix_dedup.alike(joined, anchor, at, sizes - length + 1, length, gram)
    kept = np.zeros(len(joined), bool)
    for start, count in zip(starts, counts):
        assert not kept[max(start - 1, 0) : start + count].any()
        kept[start : start + count] = True
    windows = [s + i for s, size in zip(at.tolist(), sizes.tolist()) for i in range(size - length + 1)]
    times = Counter(joined[w : w + length] for w in windows)
    shared = [w for w in windows if times[joined[w : w + length]] > 1]
    assert shared and kept[shared].all() and kept.sum() < len(windows) / 2
    assert set(np.flatnonzero(kept)) <= set(windows)


def test_texts_without_repeats(sample, odd):
    for docs in (sample, odd):
        left = suffix_dedup.without_repeats(docs)
        assert left.columns == docs.columns and left.count() == docs.count()


def test_a_row_that_stands_thousands_of_times(documents):
    """Equal rows are worked on once, and each loses its passage."""
    text = "".join(f"{i * i % 9973:04d} " for i in range(60))
    rows = [(7, text)] * 3000 + [(i + 100, f"{i:040d} {text[i:]} {i}") for i in range(20)]
    docs = documents([(i, t, "s") for i, t in rows]).repartition(4)
    assert cut(docs, length=64, gram=16) == brute(rows, 64)
