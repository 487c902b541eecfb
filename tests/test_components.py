"""Connected components against union-find."""

import random

import pytest

from newsloom.operators.components import components
from newsloom.session import stage


def model(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def shapes():
    rng = random.Random(4)
    yield [(i, i + 1) for i in range(60)]  # a path
    yield [(0, i) for i in range(1, 40)] + [(100, i) for i in range(101, 140)]  # stars
    yield [(99, i) for i in range(60)] + [(200, 201)]  # a star around its largest node
    yield [(rng.randrange(80), rng.randrange(80)) for _ in range(50)]
    yield [(5, 5)]
    yield []


@pytest.mark.parametrize("k", range(6))
def test_components_of_any_shape(spark, k):
    edges = list(shapes())[k]
    got = components(spark.createDataFrame(edges, "a long, b long"), stage).collect()
    assert len({r.node for r in got}) == len(got)
    assert {r.node: r.component for r in got} == model([e for e in edges if e[0] != e[1]])
