"""Mixing and language-model scores against plain Python."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import lm_scoring, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes):
    """Targets by sharing what is above the caps again and again; sources in order, null last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        shares = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if shares[s] > 3 * sizes[s]}
        if not above:
            return {s: 3 * sizes[s] if s in capped else shares[s] for s in order}
        capped |= above


@pytest.mark.parametrize("table", ["odd", "sample", "empty"])
def test_targets_and_words_taken(request, table):
    docs = request.getfixturevalue(table)
    rows = mixing.mix(docs).select("doc.*", "*").collect()
    assert len(rows) == docs.count()
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    want = filled(sizes) if sizes else {}
    taken = Counter()
    for r in rows:
        size = len(WORD.findall(r["text"] or ""))
        out = r[-5:]  # size, source_size, target, taken, position
        assert out[0] == size and out[1] == sizes[r["source"]]
        assert out[2] == pytest.approx(want[r["source"]])
        assert 0 <= out[3] <= 3 * size and (out[4] is None) == (out[3] == 0)
        assert out[4] is None or 0 <= out[4] <= 1
        taken[r["source"]] += out[3]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 1
    again = mixing.mix(docs).select("doc.*", "*").collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_one_large_source_and_many_small(documents):
    rows = [(i, "w " * (i % 7 + 1), "big") for i in range(400)] + [(1000 + i, "a b", f"s{i}") for i in range(40)]
    docs = documents(rows)
    want = filled({s: sum(len(t.split()) for _, t, x in rows if x == s) for s in {x for *_, x in rows}})
    got = {r["source"]: (r["target"], r["n"]) for r in mixing.mix(docs).groupBy("doc.source").agg(
        F.first("target").alias("target"), F.sum("taken").alias("n")).collect()}
    for s, target in want.items():
        assert got[s][0] == pytest.approx(target) and abs(got[s][1] - target) <= 1


def test_position_inverts_the_schedule(spark):
    frame = spark.createDataFrame([(u / 10,) for u in range(11)], "u double")
    for start, end in [(1.5, 0.5), (1.0, 1.0), (0.5, 1.5)]:
        t = mixing.position(F.col("u"), F.lit(1.0), F.lit(start), F.lit(end))
        for u, at in frame.select("u", t).collect():
            assert start * at + (end - start) * at * at / 2 == pytest.approx(u)


def test_copies_are_whole_and_sorted(sample):
    copies = mixing.mixed_copies(sample)
    assert copies.columns == sample.columns
    known = {tuple(r) for r in sample.collect()}
    counts = Counter(tuple(r) for r in copies.collect())
    assert set(counts) <= known and max(counts.values()) <= mixing.REPEATS


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0


def lowered(text):
    return [w.encode().translate(lm_scoring._LOWER) for w in WORD.findall(text or "")] + [b""]


class Plain:
    """The model from dictionaries."""

    def __init__(self, docs):
        training = [lowered(t) for i, t in docs if not held(i)]
        self.c = Counter(w for d in training for w in d)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.pairs = Counter((h, w) for d in training for h, w in zip([None, *d[:-1]], d))
        counts = np.zeros(7, np.int64)
        for c in self.pairs.values():
            counts[min(c, 7) if c < 7 else 0] += 1
        counts[0] = 0
        self.d = lm_scoring.discounts(counts)
        self.after = defaultdict(dict)
        for (h, w), c in self.pairs.items():
            self.after[h][w] = c

    def base(self, w):
        return (self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))

    def p(self, h, w):
        seen = self.after.get(h)
        if not seen:
            return self.base(w)
        total = sum(seen.values())
        kept = {x: c * (self.d[c] if c <= lm_scoring.K else 1.0) / total for x, c in seen.items()}
        if sum(kept.values()) >= 1 - 1e-12 and all(c > lm_scoring.K or self.d[c] == 1 for c in seen.values()):
            kept = {x: q * total / (total + 1) for x, q in kept.items()}
        if w in kept:
            return kept[w]
        return (1 - sum(kept.values())) * self.base(w) / (1 - sum(map(self.base, seen)))


def check_scores(frame):
    docs = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    plain, want = Plain(docs), Counter()
    for i, t in docs:
        w = lowered(t)
        base = sum(math.log10(plain.base(x)) for x in w)
        score = sum(math.log10(plain.p(h, x)) for h, x in zip([None, *w[:-1]], w))
        want[i, held(i), len(w), sum(plain.c[x] > 0 for x in w), plain.n, f"{base:.6g}", f"{score:.6g}"] += 1
    got = Counter((*r[:5], f"{r[5]:.6g}", f"{r[6]:.6g}") for r in lm_scoring.score(frame).collect())
    assert got == want
    return plain


@pytest.mark.parametrize("table", ["odd", "sample", "empty"])
def test_scores(request, table):
    check_scores(request.getfixturevalue(table))


def test_scores_over_many_chunks_and_split_histories(monkeypatch, documents):
    monkeypatch.setattr(lm_scoring, "CHUNK", 500)
    monkeypatch.setattr(lm_scoring, "BUCKET", 300)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        n = int(rng.integers(1, 60))
        rest = rng.zipf(1.5, n) % 400
        rows.append((i, " ".join(x for r in rest for x in ("the", f"w{r}")), "s"))
    plain = check_scores(documents(rows).repartition(5))
    # A history's probabilities add up to one, all unknown words being one.
    for h in [None, b"the", b"w1", b"never"]:
        assert sum(plain.p(h, w) for w in [*plain.c, b"unknown"]) == pytest.approx(1)


def test_good_turing_factors():
    found = lm_scoring.discounts(np.array([0, 1000, 300, 130, 70, 45, 32]))
    assert (found[1:] > 0).all() and (found[1:] < 1).all() and (np.diff(found[1:]) > 0).all()
    assert (lm_scoring.discounts(np.zeros(7, int))[1:] < 1).all()


def test_packed_numbers_come_back():
    for values in ([], [0], [1, 255, 256], [1 << 40, 0, 3], list(range(1000))):
        assert lm_scoring.unpacked(lm_scoring.packed(np.array(values, np.int64))).tolist() == values
