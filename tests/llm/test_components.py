import random

import pytest

from sievekit.llm import common


def union_find(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    groups = {}
    for x in up:
        groups.setdefault(find(x), set()).add(x)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("kind", ["path", "shuffled", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(kind)
    names = [rng.randrange(-(2**62), 2**62) for _ in range(60)]
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "shuffled": list(zip(names, names[1:], strict=False)),
        "star": [(7, i) for i in range(40)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)],
        "none": [],
    }[kind]
    found = common.components(spark.createDataFrame(edges, "a long, b long"), common.shared_dir(spark)).collect()
    assert len({r.v for r in found}) == len(found)
    groups = {}
    for r in found:
        groups.setdefault(r.root, {r.root}).add(r.v)
    assert {frozenset(g) for g in groups.values()} == {g for g in union_find(edges) if len(g) > 1}
