"""Exact duplicates and the divergence audit against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from tessera.llm import divergence, exact_dedup


def blanks_joined(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain_classes(rows):
    groups = defaultdict(list)
    for id, text in rows:
        groups[blanks_joined(text)].append(id)
    found = Counter()
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        for at, id in enumerate(ids):
            found[id, ids[0], len(ids), at == 0, hashlib.sha256(text.encode()).hexdigest()] += 1
    return found


def marked(docs):
    found = exact_dedup.mark(docs, ["doc_id"])
    return Counter(tuple(r) for r in found.select("doc.doc_id", *found.columns[1:]).collect())


def test_classes(sample, odd, empty):
    for docs in (sample, odd):
        assert marked(docs) == plain_classes([(r.doc_id, r.text) for r in docs.collect()])
    assert marked(empty) == Counter()
    assert exact_dedup.keep_first(odd).columns == odd.columns
    assert exact_dedup.keep_first(odd).count() == len({blanks_joined(r.text) for r in odd.collect()})


def test_blanks(documents):
    texts = ["a b", "a  b", "a\tb", "a\n\x0b\x0c\r b", " a b", "a b ", "a b", "a\x1cb", "", " ", "\n", None, "a\x00b"]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    assert marked(documents(rows)) == plain_classes([r[:2] for r in rows])


@pytest.mark.parametrize("bytes", [16_000_000, 2000])
def test_spread_groups(documents, monkeypatch, bytes):
    """Texts with far more copies than a range holds, with equal and null ids, beside pairs."""
    monkeypatch.setattr(exact_dedup, "BYTES", bytes)
    rows = [(None if i % 5 == 0 else 5000 - i % 700, "one  hot text" if i % 2 else "one hot text", "s") for i in range(2500)]
    rows += [(None, "only nulls", "s")] * 400 + [(7, "one id", "s")] * 400 + [(9000 + i, f"one hot text {i // 2}", "s") for i in range(600)]
    assert marked(documents(rows).repartition(6)) == plain_classes([r[:2] for r in rows])


def test_equal_hashes_are_told_apart(documents, monkeypatch):
    """Texts with one hash, spread or not, differ by their bytes."""
    from pyspark.sql import functions as F

    whole = exact_dedup._rows
    monkeypatch.setattr(exact_dedup, "_rows", lambda *a: whole(*a).withColumn("hash", F.lit(1).cast("long")))
    rows = [(i, f"text {i % 9}", "s") for i in range(900)]
    assert marked(documents(rows)) == plain_classes([r[:2] for r in rows])


def test_no_python_workers(sample):
    plan = exact_dedup.mark(sample)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def plain_audit(rows, least=3, ranks=200, scale=10**9):
    per, groups = defaultdict(Counter), set()
    documents = defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        per[lang, source].update(terms)
        documents[lang].update(set(terms))
    found = set()
    for lang in {g[0] for g in groups}:
        kept = sorted((t for t, n in documents[lang].items() if n >= least), key=lambda t: t.encode())
        sources = [s for g, s in groups if g == lang]

        def shares(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + scale * (counts[t] + 1) // total for t in kept}

        own = {s: shares(per[lang, s]) for s in sources}
        all_shares = shares(sum((per[lang, s] for s in sources), Counter()))

        def f(p, q):
            return (p - q) ** 2 // q

        for s in sources:
            pairs = [(sum(f(own[s][t], own[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(own[s][t], all_shares[t]), t) for t in kept if per[lang, s][t] and own[s][t] > all_shares[t]]
            for part, values in (("pair", pairs), ("term", terms)):
                values.sort(key=lambda x: (-x[0], x[1].encode()))
                found |= {(lang, s, part, item, v, i) for i, (v, item) in enumerate(values, 1) if part == "pair" or i <= ranks}
    return found


def audited(docs, **options):
    rows = [tuple(r) for r in divergence.audit(docs, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_audit_sample(sample):
    assert audited(sample) == plain_audit([(r.text, r.lang, r.source) for r in sample.collect()])


def test_audit_odd(spark, odd, empty):
    assert audited(odd) == plain_audit([(r.text, r.lang, r.source) for r in odd.collect()])
    assert divergence.audit(empty).isEmpty()
    rows = [(None, None, None), ("", "", "x"), ("One one ÉTÉ été \U0001f600", None, "y"), ("only here", "en", "a"), (None, "en", "b")]
    rows += [("one ONE two", "", s) for s in ("x", "y", "y", "")] + [("Tied ties tie", "fr", s) for s in "aabbcc"]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert audited(docs) == plain_audit(rows)


def test_audit_ties_beyond_the_limit(spark):
    """Far more terms of one value than ranks, in several cells of that value."""
    rows = [(" ".join(f"w{chr(0x4E00 + i)}" for i in range(500)) + " rare" * (i == 0), "en", s) for s in "ab" for i in range(3)]
    rows += [("only of b " + " ".join(f"v{chr(0x4E00 + i)}" for i in range(90)), "en", "b")] * 3
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    for ranks in (7, 91, 200):
        assert audited(docs, ranks=ranks) == plain_audit(rows, ranks=ranks)
    assert audited(docs, scale=50) == plain_audit(rows, scale=50)
