from __future__ import annotations

import math
import random

import numpy as np
import pytest
from helpers import sf_table

from vigil.llm import hardneg
from vigil.llm.hardneg import MiningRules

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, rules):
    """Every anchor against every row."""
    seen, own = set(), []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(rules.scale * x) for x in v]
        key = (i, label, tuple(ints))
        if key not in seen:
            seen.add(key)
            own.append(key)
    out = []
    for a in own:
        if a[0] % rules.anchor_every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1]) for r in own if r is not a)
        for s, p, _ in [x for x in scored if x[2] == a[1]][: rules.positives]:
            near = [x for x in scored if x[2] != a[1] and rules.low * -s <= 100 * -x[0] <= rules.high * -s][: rules.negatives]
            out += [(a[0], p, k, x[1], -s, -x[0]) for k, x in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows, rules, clash=True):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    if clash:
        df = df.selectExpr("*", *[f"'x' AS `{c}`" for c in ["v", "block", "grp", "at", "rank", "place", "windows", "low", "n"]])
    return sorted(tuple(r[c] for c in COLUMNS) for r in hardneg.hard_negatives(df, rules).collect())


@pytest.mark.parametrize("zones", [hardneg.ZONES, 3])
def test_against_every_row(spark, monkeypatch, zones):
    monkeypatch.setattr(hardneg, "ZONES", zones)
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in sf_table("embeddings")]
    rules = MiningRules(anchor_every=20, block_rows=32, group_rows=8)
    got = mined(spark, rows, rules, clash=False)
    assert got == plain(rows, rules) and len(got) > 500


def test_edges(spark):
    rng = random.Random(5)
    vec = lambda n=3: [rng.choice([-0.5, -0.1, 0.1, 0.25, 0.5]) for _ in range(n)]  # many ties
    rows = [(i, vec(), i % 3) for i in range(200)]
    rows += [(7, [0.1, None, 0.2], 1), (8, [float("nan")] * 3, 1), (10, [float("inf"), 0.0, 0.0], 0), (None, vec(), 1), (20, None, 1), (30, vec(), None)]
    rows += [rows[0], rows[10], rows[11], (10, vec(), 1), (40, vec(), 2), (41, vec(2), 0), (300, vec(2), 1), (310, [], 2), (320, [0.5] * 5, 9)]
    rules = MiningRules(anchor_every=10, block_rows=16, group_rows=4)
    got = mined(spark, rows, rules)
    assert got == plain(rows, rules) and len(got) > 300
    assert mined(spark, [], rules) == []
    assert mined(spark, [(10, [], 1), (11, [], 1), (12, [], 2)], rules) == [(10, 11, 1, 12, 0, 0)]
    assert mined(spark, [(10, [0.5], 1)], rules) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**24 + 2 * i), float(-(2**23)) * i], i % 2) for i in range(40)]
    rules = MiningRules(anchor_every=10, block_rows=8, group_rows=4, scale=1)
    assert mined(spark, rows, rules) == plain(rows, rules)


def test_most_rows_in_one_copy_group(spark):
    rows = [(i, [0.5, 0.25], 1) for i in range(300)] + [(1000 + i, [0.3 + i / 1000, 0.1], 2) for i in range(100)]
    rules = MiningRules(anchor_every=50, block_rows=16, group_rows=4)
    assert mined(spark, rows, rules) == plain(rows, rules)


def test_bounds_skip_blocks_that_no_window_needs():
    rng = np.random.default_rng(3)
    centres = rng.integers(-200, 200, (4, 16))
    v = np.concatenate([c + rng.integers(-3, 4, (64, 16)) for c in centres])
    z = hardneg.Zones.__new__(hardneg.Zones)
    z.block, z.n = np.arange(16), np.full(16, 16)
    parts = v.reshape(16, 16, 16)
    z.low, z.high, z.least, z.most = parts.min(1), parts.max(1), np.repeat(np.arange(4), 4), np.repeat(np.arange(4), 4)
    low, high = hardneg.score_bounds(v[:5], z.low, z.high)
    scores = (v[:5] @ v.T).reshape(5, 16, 16)
    assert (low <= scores.min(2)).all() and (scores.max(2) <= high).all()
    window = np.full((5, 1), scores[:, 4:].max()), np.full((5, 1), scores[:, 4:].max() + 5)
    read = hardneg.negative_blocks(v[:5], np.zeros(5, np.int64), *window, z)
    assert read.any() and not read[:, :4].any() and read.sum() < 5 * 12
    assert (hardneg.positive_blocks(v[:5], np.zeros(5, np.int64), z, 3).sum(1) <= 4).all()


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        rank = hardneg.hilbert_rank(cells, bits)
        assert sorted(rank.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(rank)], axis=0)).sum(1)
        assert (steps == 1).all()
