from __future__ import annotations

import random

from helpers import Union

from vigil.llm.common import Scratch
from vigil.llm.components import connected_components


def test_random_graphs_and_a_chain(spark):
    rng = random.Random(5)
    for edges in ([(i, i + 1) for i in range(60)], [(rng.randrange(80), rng.randrange(80)) for _ in range(60)], [(0, i) for i in range(50)] + [(3, 3), (None, 4), (70, 71), (71, 70)]):
        nodes = sorted({x for a, b in edges if None not in (a, b) and a != b for x in (a, b)})
        u = Union(100)
        for a, b in edges:
            if None not in (a, b):
                u.join(a, b)
        got = {(r.node, r.component) for r in connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
        assert got == {(x, u.find(x)) for x in nodes}


def test_empty(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0
