from __future__ import annotations

import numpy as np
import pytest
import xxhash
from helpers import Union, docs_df, sf_table, words

from vigil.llm import queries, simhash


def naive(text):
    w = [x.encode() for x in words((text or "").translate({i: i + 32 for i in range(65, 91)}))]
    if not w:
        return 0
    h = [xxhash.xxh64(b" ".join(w[i : i + 3]), seed=42).intdigest() for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h))


def components(fps, bits):
    u = Union(len(fps))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps[i + 1 :]) <= bits):
            u.join(i, i + 1 + int(j))
    return u


def test_whole_table_equals_brute_force(spark):
    from helpers import SF

    docs = sf_table("documents")
    fps = np.array([naive(d["text"]) for d in docs], np.uint64)
    u = components(fps, 3)
    least = {}
    for i, d in enumerate(docs):
        least[u.find(i)] = min(least.get(u.find(i), d["doc_id"]), d["doc_id"])
    want = {(d["doc_id"], f"{int(f):016x}", least[u.find(i)]) for i, (d, f) in enumerate(zip(docs, fps))}
    assert {tuple(r) for r in queries.op8_simhash_gray_index(spark, SF).collect()} == want


@pytest.mark.parametrize("seed,n,flips", [(0, 700, 6), (1, 900, 2), (2, 300, 40)])
def test_index_components(seed, n, flips):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = []
    for _ in range(n):
        x = int(base[rng.integers(12)])
        for b in rng.integers(0, 64, rng.integers(0, flips)):
            x ^= 1 << int(b)
        fps.append(x)
    fps = np.unique(np.array(fps, np.uint64))
    index = simhash.GrayIndex(fps)
    u = components(index.fps, 3)
    assert index.components(3).tolist() == [u.find(i) for i in range(len(fps))]


def test_gray_rank_is_the_place_in_the_gray_sequence():
    i = np.arange(64, dtype=np.uint64)
    assert simhash.gray_rank(i ^ (i >> np.uint64(1))).tolist() == list(range(64))


def test_split_groups_give_the_same_links(spark):
    rng = np.random.default_rng(3)
    fps = sorted({int(x) ^ (1 << int(b)) for x in rng.integers(0, 1 << 62, 40) for b in rng.integers(0, 62, 8)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")

    def closure(hot):
        place = {f: i for i, f in enumerate(fps)}
        u = Union(len(fps))
        for r in simhash.links(df, 3, hot_rows=hot).collect():
            u.join(place[r.u], place[r.v])
        return [u.find(i) for i in range(len(fps))]

    assert closure(2) == closure(100_000)


def test_edges(spark):
    long = "Word soup " * 50_000
    rows = [(5, None), (3, ""), (4, " \n"), (9, "A b C"), (8, "a B c"), (7, long), (7, long), (None, "only null")]
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs_df(spark, rows)).collect()}
    assert {(5, 3), (3, 3), (4, 3), (9, 8), (8, 8), (7, 7), (None, None)} == got
    assert simhash.near_duplicates(docs_df(spark, rows)).count() == len(rows)
    assert simhash.near_duplicates(docs_df(spark, rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        simhash.links(spark.range(1).withColumnRenamed("id", "fp"), 4)
