from __future__ import annotations

from collections import Counter

import pytest
from helpers import docs_df, words
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.llm import quality as Q


def brute(text):
    w = words(text)
    n = len(w)
    seen = Counter(tuple(w[i : i + 8]) for i in range(n - 7))
    covered = {j for i in range(n - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    old, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in old
            old.add(line)
    top = 0
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and w[i + k] == w[j + k]:
                k += 1
            top = max(top, k)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), top if top >= 8 else 0, failed


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "é#", "c\n", "\n", "d\x0be"]), max_size=60), max_size=4))
def test_measures_equal_brute_force(parts):
    texts = [" ".join(p) for p in parts]
    for text, got in zip(texts, Q.measure(texts, Q.QualityRules())):
        assert (*got[:5], got[6], got[8]) == brute(text)


def test_verdict():
    clean = " ".join(f"w{i}" for i in range(300))
    copy = " ".join(f"w{i}" for i in range(100))
    one_long = clean + " " + copy + " " + " ".join(f"x{i}" for i in range(600))
    got = Q.measure([clean, clean + " " + clean, one_long, "spam and eggs " * 40], Q.QualityRules())
    assert [g[-1] for g in got] == [True, False, True, False]
    assert got[2][6] == 100 and got[2][4] == 200
    assert not Q.measure([one_long], Q.QualityRules(max_longest=50))[0][-1]


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (None, long), (3, "\n \n"), (4, long), (4, long)]
    got = sorted((r.doc_id or 0, r.n_words, r.kept) for r in Q.repetition(docs_df(spark, rows)).collect())
    assert got == [(0, 30000, True), (1, 0, False), (2, 0, False), (3, 0, False), (4, 30000, True), (4, 30000, True)]
    df = docs_df(spark, rows)
    kept = Q.keep_good(df)
    assert kept.columns == df.columns and kept.count() == 3
    assert Q.repetition(df.limit(0)).count() == 0 and Q.keep_good(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5000])
def test_one_word_text(n):
    (got,) = Q.measure(["a " * n], Q.QualityRules())
    assert got[0] == n and got[4] == (n if n >= 9 else 0)
