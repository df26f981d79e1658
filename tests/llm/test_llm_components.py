"""Components from stars made inside tasks, and the rounds that are left."""

import random

import numpy as np
import pytest
from tickfold.llm import components as module
from tickfold.llm.components import components, stars_of


def least(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_of_chains_hubs_and_random_edges(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(1000, 1400)]
    hub = [(5000, i) for i in range(5001, 5300)]
    some = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in chain + hub + some + some[:50]]
    rng.shuffle(edges)
    want = {x: r for x, r in least([e for e in edges if e[0] != e[1]]).items()}
    a, b = stars_of(*np.array(edges, np.int64).T)
    assert dict(zip(a.tolist(), b.tolist())) == {x: r for x, r in least(edges).items() if x != r}
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(9)).collect()
    assert len(got) == len(want) and {r["id"]: r["component"] for r in got} == want


def test_stars_need_no_round(spark, monkeypatch):
    """What tasks have tied together already is not sent through rounds of shuffles."""
    monkeypatch.setattr(module, "_stars", lambda edges: pytest.fail("a round"))
    edges = [(i, 10 * (i // 10)) for i in range(100)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    assert {r["id"]: r["component"] for r in components(df).collect()} == dict(edges)
    none = spark.createDataFrame([], "a long, b long")
    assert components(none).collect() == []
