"""Components against a union-find, and the rounds that a long chain takes."""

import random

import pytest

from plimsoll.llm import components as module

N = 10_000


def brute(edges):
    root = {}

    def find(v):
        while root.setdefault(v, v) != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {v: find(v) for v in root}


def found(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    rows = module.components(frame).collect()
    assert len({r.v for r in rows}) == len(rows)
    return {r.v: r.root for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_edges(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(-200, 200), draw.randrange(-200, 200)) for _ in range(150)]
    assert found(spark, edges + edges[:20]) == brute(edges)


def test_stars_loops_and_nothing(spark):
    star = [(7, v) for v in range(8, 300)] + [(5, 5)]
    assert found(spark, star) == brute(star)
    assert found(spark, []) == {}


@pytest.mark.parametrize("sorted_ids", [True, False])
def test_rounds_of_a_long_chain(spark, monkeypatch, sorted_ids):
    """A chain of 10,000 takes at most 20 rounds, in order of ids and in none."""
    ids = list(range(N))
    if not sorted_ids:
        random.Random(1).shuffle(ids)
    rounds = []
    hooked = module._hooked
    monkeypatch.setattr(module, "_hooked", lambda edges: rounds.append(1) or hooked(edges))
    edges = list(zip(ids, ids[1:]))
    assert set(found(spark, edges).values()) == {0}
    assert len(rounds) <= 20
