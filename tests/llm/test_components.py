"""Connected components against union-find."""

import random

import pytest

from paddock.llm.components import components


@pytest.mark.parametrize("edges", [
    [], [(1, 2)], [(2, 1), (1, 2), (3, 3)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)],
    [(random.Random(7).randint(0, 0) + a, b) for a, b in [(random.Random(i).randrange(80), random.Random(i + 999).randrange(80)) for i in range(60)]],
])
def test_against_union_find(spark, edges):
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    rows = components(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == want and len(rows) == len(want)
