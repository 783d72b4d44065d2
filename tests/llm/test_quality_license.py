"""Quality rules and licence scans against plain Python."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import license_scan, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {p for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def row_key(row):
    return repr(tuple(row))


def measured(docs):
    found = quality_rules.measure(docs)
    return sorted(
        found.select("doc.doc_id", "doc.text", *found.columns[1:]).collect(), key=row_key
    )


@pytest.mark.parametrize("table", ["odd", "sample", "empty"])
def test_counts(request, table):
    docs = request.getfixturevalue(table)
    rows = measured(docs)
    assert len(rows) == docs.count()
    for r in rows:
        want = counts(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_repeats_overlap(documents):
    line = "a b c d e f g h i j"
    texts = [line, f"{line} {line}", f"{line} x {line} y {line}", "z " * 9, "z " * 8, f"{line}\n{line}\n \n \n{line}"]
    rows = measured(documents([(i, t, "s") for i, t in enumerate(texts)]))
    for r in rows:
        assert r["n_repeat_words"] == counts(r["text"])[4] and r["n_dup_lines"] == counts(r["text"])[3]


def test_order_does_not_change_the_verdict(sample):
    judged = quality_rules._prepared(sample, "text")
    columns = [
        quality_rules.cascade(rules, F.col("text"), F.col("w")).isNull().alias(f"c{i}")
        for i, rules in enumerate([quality_rules.RULES, quality_rules.RULES[::-1]])
    ]
    assert judged.select(*columns).where("c0 <> c1").count() == 0


def test_keep_good_keeps_columns(sample, odd, empty):
    for docs in (sample, odd, empty):
        kept = quality_rules.keep_good(docs)
        assert kept.columns == docs.columns
    assert 0 < quality_rules.keep_good(sample).count() < sample.count()


def base_places(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = LETTERS.findall(lowered)
    found = []
    for t in license_scan.BASE:
        phrase = t.text.split()
        found += [(i, t.label) for i in range(len(w)) if w[i : i + len(phrase)] == phrase]
    return len(w), found


@pytest.fixture(scope="module")
def licences(documents):
    texts = [
        "This work is licensed under the GNU General Public License, version 3.",
        "mit license mit license MIT LICENSE and cc-by cc by",
        "Released under the Apache License; gnu general public licens",
        "Permission is hereby granted, free of any charge, to any person obtaining a copy of this software",
        "apache", "éapache license", "gnu general public license " * 5,
    ]
    return documents([(i, t, "s") for i, t in enumerate(texts)])


@pytest.mark.parametrize("table", ["odd", "sample", "empty", "licences"])
def test_licences(request, table):
    docs = request.getfixturevalue(table)
    texts = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in docs.select("doc_id", "text").collect())
    rows = license_scan.scan(docs).collect()
    assert len(rows) == len(texts)
    want = Counter()
    for none, doc_id, text in texts:
        n, found = base_places(text)
        starts = [i for i, _ in found]
        labels = ",".join(sorted({x for _, x in found}))
        want[None if none else doc_id, n, len(found), min(starts, default=None), max(starts, default=None), labels] += 1
    got = Counter(
        (r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows
    )
    assert got == want
    for r in rows:
        labels, base = r["labels"].split(","), r["base_labels"].split(",")
        assert set(base) - {""} <= set(labels) and labels == sorted(labels)
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "")


def test_spans_survive_added_words(licences):
    labels = {r["doc_id"]: r["labels"] for r in license_scan.scan(licences).collect()}
    assert "gpl-3.0" in labels[0] and labels[3] == "mit-grant" and labels[4] == ""


def test_whole_phrases_next_to_partial_repeats(documents):
    grant = "permission is hereby granted free of charge to any person obtaining a copy of this software"
    texts = [
        ("released under the MIT license (the MIT license)", "mit,mit-notice", 1.0),
        ("the mit license the mit license released under the mit license under the mit license the mit license", "mit,mit-notice", 1.0),
        ("released under the the mit license x the mit license x the mit license", "mit,mit-notice", None),
        (f"{grant[:30]} {grant} of this software", "mit-grant", 1.0),
        (f"of charge to {grant.replace('free ', '')} a copy of a copy of", "mit-grant", None),
        (f"{grant} {grant}", "mit-grant", 1.0), ("released under", "", 0.0),
    ]
    rows = {r["doc_id"]: r for r in license_scan.scan(documents([(i, t, "s") for i, (t, _, _) in enumerate(texts)])).collect()}
    for i, (text, labels, score) in enumerate(texts):
        assert rows[i]["labels"] == labels, text
        assert score is None or rows[i]["score"] == score, text


def test_templates_of_any_length(documents):
    words = [f"w{i}" for i in range(700)]
    long = license_scan.Template(" ".join(words), "long")
    exact = license_scan.Template(" ".join(words[:150]), "exact", True)
    mit = license_scan.TEXTS[0].text
    texts = [
        " ".join(words), " ".join(words[:149]), " ".join(["x", *words[:150], "y", *words[:150]]),
        " ".join(words[:300] + ["new"] * 20 + words[310:]), " ".join(words[:520]), " ".join(words[::2]), None,
    ]
    rows = license_scan.scan(documents([(i, t, "s") for i, t in enumerate(texts)]), phrases=[long, exact]).collect()
    found = {r["doc_id"]: (r["labels"], r["n_words"]) for r in rows}
    assert found == {
        0: ("exact,long", 700), 1: ("", 149), 2: ("exact", 302), 3: ("exact,long", 710), 4: ("exact", 520), 5: ("", 350), 6: ("", 0)
    }
    changed = mit.replace("Software", "Program").replace("copyright holders", "owners")
    kept = [(1, f"Copyright me. {mit} end", "s"), (2, mit.replace("sell copies", "sell some more copies"), "s"), (3, changed, "s")]
    rows = {r["doc_id"]: r for r in license_scan.scan(documents(kept)).collect()}
    assert all("mit-grant" in rows[i]["labels"] for i in (1, 2)) and rows[1]["score"] == 1.0
    assert "mit-text" in rows[1]["labels"] and "mit-text" in rows[2]["labels"]
    with pytest.raises(ValueError):
        license_scan.scan(documents(kept), phrases=[license_scan.Template("word", "w")])


def test_each_equal_row_has_its_result(documents, monkeypatch):
    monkeypatch.setattr(license_scan, "COPIES", 7)
    rows = license_scan.scan(documents([(1, "the mit license", "s")] * 30 + [(None, None, "s")] * 14 + [(1, "x", "s")])).collect()
    assert Counter((r["doc_id"], r["n_words"], r["labels"]) for r in rows) == {(1, 3, "mit"): 30, (None, 0, ""): 14, (1, 1, ""): 1}


def test_the_order_of_rules_is_by_rejections_per_cost(spark):
    cheap = quality_rules.Rule("cheap", lambda t, w: F.length(t) < 5)
    never = quality_rules.Rule("never", lambda t, w: F.length(t) < 0)
    dear = quality_rules.Rule("dear", lambda t, w: (F.length(t) < 5) & (quality_rules.n_repeat_words(w) >= 0))
    docs = spark.range(400).select(F.when(F.col("id") % 2 == 0, F.repeat(F.lit("some words "), 900)).alias("text"))
    order = [r.name for r in quality_rules.estimate(docs, [never, dear, cheap])]
    assert order == ["cheap", "dear", "never"]
    long = docs.select(F.repeat(F.lit("x"), quality_rules.SAMPLE_CHARS + 1).alias("text"))
    for rows in (docs.limit(0), long):
        assert quality_rules.estimate(rows, [never, dear, cheap]) == [never, dear, cheap]
