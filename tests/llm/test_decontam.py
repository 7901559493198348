from __future__ import annotations

import re
from collections import defaultdict

import pytest
from helpers import SF, docs_df, sf_table

from vigil.llm import decontam, queries


def split(text):
    return [w for w in re.split("[ \t\n\x0b\f\r]+", (text or "").lower()) if w]


def brute(docs, items, rules=decontam.SeedRules()):
    """(doc_id, item_id) with an aligned run of enough equal words."""
    texts = {i: split(t) for i, t in items}
    where = defaultdict(list)
    for i, w in texts.items():
        for p, x in enumerate(w):
            where[x].append((i, p))
    out = set()
    for doc, text in docs:
        w, diag = split(text), defaultdict(set)
        for p, x in enumerate(w):
            for i, q in where.get(x, ()):
                diag[i, p - q].add(p)
        for (i, d), same in diag.items():
            n = min(rules.min_words, len(texts[i]))
            if len(texts[i]) < rules.least_item_words:
                continue
            for s in range(max(0, d), min(len(w), len(texts[i]) + d) - n + 1):
                if sum(k in same for k in range(s, s + n)) >= rules.similarity * n - 1e-9:
                    out.add((doc, i))
    return out


def test_whole_table_equals_all_alignments(spark):
    docs = [(d["doc_id"], d["text"]) for d in sf_table("documents")]
    want = brute(docs, [(b["item_id"], b["text"]) for b in sf_table("benchmark")])
    rows = queries.op10_spaced_seed_decontamination(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in docs)
    assert {(r.doc_id, i) for r in rows for i in r["items"]} == want
    assert all(r.contaminated == bool(r["items"]) and r.n_items == len(r["items"]) for r in rows)


def items_df(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' AS h", "'y' AS doc_id", "1 AS item")


def test_substitutions_and_edges(spark):
    item = [f"q{i}" for i in range(40)]
    swapped = [w if i % 8 != 5 else "other" for i, w in enumerate(item)]
    heavy = [w if i % 3 else "other" for i, w in enumerate(item)]
    filler = [f"f{i}" for i in range(9000)]
    rows = [
        (1, " ".join(filler[:50] + swapped + filler[50:90])),
        (2, " ".join(filler[:50] + heavy)),
        (3, " ".join(filler[:4090] + item[10:24] + filler[4090:])),
        (4, " ".join(item[:9])),
        (5, None),
        (6, ""),
        (None, " ".join(item)),
        (7, "x y SHORT item of six words z"),
        (8, "tiny item"),
        (1, "harmless"),
        (9, "a b c d e f g"),
    ]
    bench = items_df(spark, [(10, " ".join(item)), (10, " ".join(item)), (11, "short item of six words"), (12, "tiny item"), (13, None), (None, "a b c d e f")])
    got = {r.doc_id: (r.contaminated, list(r["items"])) for r in decontam.contamination(docs_df(spark, rows), bench).collect()}
    yes, no = (True, [10]), (False, [])
    assert got == {1: yes, 2: no, 3: yes, 4: no, 5: no, 6: no, None: yes, 7: (True, [11]), 8: (True, [12]), 9: (True, [])}
    clean = decontam.clean_documents(docs_df(spark, rows), bench)
    assert clean.columns == docs_df(spark, rows).columns
    assert sorted((r.doc_id, (r.text or "")[:8]) for r in clean.collect()) == [(1, "harmless"), (2, "f0 f1 f2"), (4, "q0 q1 q2"), (5, ""), (6, "")]
    assert decontam.contamination(docs_df(spark, rows), bench.limit(0)).where("contaminated").count() == 0
    assert decontam.contamination(docs_df(spark, rows).limit(0), bench).count() == 0


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = decontam.overlaps(docs, bench).collect()
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, decontam.overlaps(docs, bench).collect())) == sorted(map(tuple, want))


def test_every_allowed_substitution_of_every_length_is_found(spark):
    from itertools import combinations

    rules = decontam.SeedRules()
    assert [n for n in range(1, 14) if decontam.missed(rules, n)] == [1, 2, 3, 4, 5, 6, 7, 8, 10]
    items, docs = [], []
    for n in range(1, 15):
        words = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(words)))
        span = min(n, rules.min_words)
        for count in (rules.substitutions(span), rules.substitutions(span) + 1):
            for changed in combinations(range(span), count):
                docs.append((len(docs), " ".join(["before"] * 3 + ["other" if i in changed else w for i, w in enumerate(words)] + ["after"])))
    want = brute(docs, items)
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(docs_df(spark, docs), items_df(spark, items)).collect()}
    assert got == want and len(want) > 200


@pytest.mark.parametrize("similarity", [0.5, 0.7, 1.0])
def test_own_masks_leave_one_intact(similarity):
    from itertools import combinations

    rules = decontam.SeedRules(similarity=similarity)
    for n in range(1, rules.min_words + 1):
        for changed in combinations(range(n), rules.substitutions(n)):
            assert any(all(m[i] == "0" for i in changed) for m in decontam.own_masks(rules, n)), (n, changed)


def test_masks_are_checked():
    with pytest.raises(ValueError):
        decontam.SeedRules(masks=("0110",))
