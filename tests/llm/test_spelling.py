"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from tessera.llm import spelling

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def linked(counts):
    """All words' rows by comparing every pair."""
    words, rows = sorted(counts), {}
    for w in words:
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form = best if best and counts[best] >= 2 * counts[w] else None
        rows[w] = [form, counts[w], len(others), counts[form] if form else None]
    found = set()
    for w in words:
        root = w
        while rows[root][0]:
            root = rows[root][0]
        found.add((w, rows[w][0], root, *rows[w][1:]))
    return found


def plain(rows):
    counts = Counter()
    for doc, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return linked({w: n for w, n in counts.items() if n >= 3 and len(w) >= 5})


def rows_of(found):
    return [tuple(r[c] for c in COLUMNS) for r in found.collect()]


def same(found, expected):
    rows = rows_of(found)
    assert len(rows) == len(set(rows)) and set(rows) == expected


def test_sample(sample):
    some = sample.orderBy("doc_id").limit(25)
    expected = plain([(r.doc_id, r.text) for r in some.collect()])
    assert sum(r[4] for r in expected) > 20
    same(spelling.variants(some), expected)


def test_odd(odd, empty):
    expected = plain([(r.doc_id, r.text) for r in odd.collect()])
    same(spelling.variants(odd), expected)
    assert spelling.variants(empty).columns == COLUMNS and spelling.variants(empty).isEmpty()


@pytest.mark.parametrize("frequent, table", [(64, 1 << 18), (1, 1 << 18), (0, 1 << 18), (0, 50)])
def test_crowded_words(spark, frequent, table):
    """Few letters, so that nearly all words are near to others, and grams repeat inside words."""
    pick = random.Random(5)
    words = {"".join(pick.choices("ab", k=pick.randint(5, 9))) for _ in range(250)} | {"a" * 5, "a" * 6, "a" * 40, "a" * 41, "b" + "a" * 40}
    words |= {"".join(pick.choices("abcdé", k=12)) for _ in range(40)}
    for w in list(words)[:120]:
        at = pick.randrange(len(w) + 1)
        words |= {w[:at] + pick.choice("abé") + w[at:], w[:at] + "ÿ" + w[at + 1 :]}
    counts = {w: pick.randint(3, 60) for w in words if len(w) >= 5}
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {tuple(r) for r in spelling.near_pairs(vocabulary, table, frequent).collect()}
    assert found == {(a, b) for a in counts for b in counts if near(a, b)}
    assert len(spelling.dictionary(vocabulary, table, frequent)) <= table


def test_no_edit_affects_both_probes():
    pick = random.Random(2)
    for _ in range(3000):
        word = "".join(pick.choices("abc", k=pick.randint(5, 20)))
        frequent = {"".join(pick.choices("abc", k=q)): pick.randint(1, 9) for q in (2, 2, 2, 3, 3, 4, 5)}
        longest = min(8, (len(word) + 2) // 2)
        marked = f"\x02{word}\x03"
        grams = spelling.decompose(marked, longest, frequent)
        ends = [e for _, e in grams]
        assert ends == sorted(set(ends)) and ends[-1] == len(marked) and all(0 < e - s <= longest for s, e in grams)
        left, right = spelling.probes(marked, grams, longest, frequent)
        assert grams[right][1] - grams[left][1] >= longest


def test_long_chains(spark):
    """Forms that lead on: each word twice as frequent as the one before."""
    steps = ["a" * (5 + i) for i in range(20)]
    forms = spark.createDataFrame([(a, b) for a, b in zip(steps, steps[1:])] + [(steps[-1], None), ("alone", None)], "word string, form string")
    found = {r.word: r.root for r in spelling.roots(forms).collect()}
    assert found == dict.fromkeys(steps, steps[-1]) | {"alone": "alone"}
