"""Connected components against union-find, and the work of later rounds."""

import random

import pytest

from paylens.llm import components as module


def union_find(edges):
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {x: top(x) for e in edges if e[0] != e[1] for x in e}


GRAPHS = {
    "none": [], "loop": [(3, 3)], "chain": [(k, k + 1) for k in range(60)], "falling star": [(100, k) for k in range(30)],
    "stars in a chain": [(k, 100 + k // 5) for k in range(50)] + [(100 + k, 5 * k + 5) for k in range(9)],
    "random": [(a, b) for rng in [random.Random(3)] for a, b in [(rng.randrange(-90, 90), rng.randrange(-90, 90)) for _ in range(110)]],
    "both ways": [(5, 2), (2, 5), (5, 2), (9, 5), (7, 8)]}


@pytest.mark.parametrize("name", GRAPHS)
def test_roots_are_the_smallest_nodes(spark, name):
    edges = GRAPHS[name]
    found = module.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.root for r in found} == union_find(edges)


def test_later_rounds_see_only_what_is_left(spark, monkeypatch):
    """A dense group: once its classes hang together, their edges are not read again."""
    sizes, whole = [], module.materialise

    def spied(df):
        done = whole(df)
        if done.columns == ["a", "b"]:
            sizes.append(done.count())
        return done
    monkeypatch.setattr(module, "materialise", spied)
    edges = [(a, b) for a in range(40) for b in range(a)] + [(k, k + 1) for k in range(100, 140)]
    module.components(spark.createDataFrame(edges, "a long, b long"))
    assert sizes[0] == len(edges) and sum(sizes[1:]) < len(edges) / 10 and sizes[-1] == 0
