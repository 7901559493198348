from __future__ import annotations

import random
import zlib

from helpers import SF, docs_df, sf_table

from vigil.llm import queries
from vigil.llm import toxicity as T
from vigil.llm.common import Scratch


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng, rules = random.Random(3), T.ToxicRules()
    terms = ["abcab", "bacab", "aabbccaab", "cab", "abc*", "bbbbb"]
    lex = T.FuzzyLexicon(terms, rules)
    for _ in range(4000):
        w = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 12)))
        near = [(distance(w, t), i) for i, t in enumerate(terms) if not t.endswith("*") and distance(w, t) <= lex.edits[i]]
        got = lex.match(w)
        if w.startswith("abc"):
            assert got == (4, 0)
        else:
            assert got == ((min(near)[1], min(near)[0]) if near else None), w


def test_quotation():
    assert T.quoted('he said "you idiot" today', 13, 18, 40)
    assert T.quoted("er sagte „idiot“ laut", 10, 15, 40)
    assert not T.quoted("you idiot, really", 4, 9, 40)
    assert not T.quoted('"fine" you idiot "ok', 11, 16, 5)


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op2_levenshtein_toxicity(spark, SF).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for i, r in rows.items())
    rated = [(rows[x["doc_id"]], x["toxic"]) for x in sf_table("labels") if rows[x["doc_id"]].held_out]
    assert sum(r.predicted == y for r, y in rated) >= 0.9 * len(rated)
    # the score ranks toxic documents above others
    pairs = [(a.score > b.score) + 0.5 * (a.score == b.score) for a, x in rated for b, y in rated if x > y]
    assert sum(pairs) >= 0.85 * len(pairs)


def corpus(rng, n):
    filler = ["the", "report", "was", "long", "and", "quiet", "river", "stone", "garden", "window"]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(filler) for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            w[rng.randrange(30)] = rng.choice(["blockhead", "numbskull", "grubo" + rng.choice(["la", "ti", "ne", "rum"])])
        elif i % 7 == 1:
            k = rng.randrange(1, 28)
            w[k] = '"' + rng.choice(["blockhead", "numbskull"]) + '"'
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_misspelt_quoted_and_stems(spark):
    rows, labels = corpus(random.Random(4), 400)
    model = T.fit(docs_df(spark, rows), spark.createDataFrame([*labels, (None, 1), (1, None), (0, 1)], "doc_id long, toxic int"), T.ToxicRules(), Scratch(spark, "toxic-test"))
    plain = "the report was long and quiet "
    assert model.score(plain) < 0.3
    assert model.score(plain + "you blockhead") > 0.3
    assert model.hits("a blokhead passed")[0][4] == 1
    assert model.score(plain + "grubovix") > 0.3
    assert model.score(plain + 'he said "blockhead" and left') < model.score(plain + "he said blockhead and left")


def test_edges(spark):
    empty = T.fit(docs_df(spark, []), spark.createDataFrame([], "doc_id long, toxic int"), T.ToxicRules(), Scratch(spark, "toxic-test"))
    rows = [(1, None), (2, ""), (None, "x"), (3, "y " * 100_000), (3, "y " * 100_000)]
    out = T.toxicity(docs_df(spark, rows), empty).collect()
    assert len(out) == 5 and all(r.predicted == 0 and 0 <= r.score <= 1 for r in out)
    assert T.toxicity(docs_df(spark, rows).limit(0), empty).count() == 0
