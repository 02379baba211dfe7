"""Centroid clustering against plain Python integers, with ties, repeated rows, nulls and very large components."""

import hashlib
import math
import random

import pytest

from chartdex.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, id long, distance string"
BAD = [None, [], [1.0, None, 2.0, 3.0], [1.0, float("nan"), 2.0, 3.0], [1.0, float("inf"), 2.0, 3.0], [1.0, 2.0, 3.0]]


def by_hand(rows, k, rounds, scale=64):
    kept = [(i, [math.floor(scale * x) if abs(x) < 2**53 else int(x) * scale for x in v]) for i, v in rows]
    drawn = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    points = [v for _, v in sorted(kept, key=drawn)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        of = {}
        for _, v in kept:
            of.setdefault(nearest(v)[1], []).append(v)
        points = [[sum(x) // len(of[c]) for x in zip(*of[c])] if c in of else p for c, p in enumerate(points)]
    found = [(i, nearest(v)) for i, v in kept]
    total = sum(d for _, (d, _) in found)
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    cut = lambda x: min(x, centroids.LARGEST)
    return sorted((str(i), c, cut(d), cut(sum(e for _, (e, f) in found if f == c)), cut(total), digest[c]) for i, (d, c) in found)


def run(spark, rows, k=4, rounds=3):
    df = spark.createDataFrame([(i, v, "x", 7, "y") for i, v in rows], SCHEMA).repartition(3)
    found = centroids.cluster_vectors(df, k=k, rounds=rounds, dims=4)
    return sorted((str(r["vec_id"]), *list(r)[1:]) for r in found.collect())


@pytest.mark.parametrize("seed", range(3))
def test_random_vectors(spark, seed, monkeypatch):
    monkeypatch.setattr(centroids, "PIECE", 16)
    r = random.Random(seed)
    grid = [-0.5, -0.25, 0.0, 0.01, 0.5]  # few values, so many ties and shared subvectors
    rows = [(i, [r.choice(grid) for _ in range(4)]) for i in range(150)]
    rows += [rows[3]] * 40 + [(rows[4][0], [0.5] * 4), (None, [0.25] * 4)]
    assert run(spark, rows + [(1000 + i, v) for i, v in enumerate(BAD)]) == by_hand(rows, 4, 3)


def test_components_that_no_long_holds(spark):
    rows = [(1, [1e300, -1e300, 0.0, 1.0]), (2, [1e18, 2.0, 3.0, -1e18]), (3, [0.1, 0.2, 0.3, 0.4]), (4, [1e300, -1e300, 5.0, 1.0])]
    rows += [(5, [2.0**21, -(2.0**21), 0.5, 0.25]), (6, [1e12, 1e12, 1e12, 1e12])]
    got = run(spark, rows, k=3)
    assert got == by_hand(rows, 3, 3)
    assert max(r[4] for r in got) == centroids.LARGEST


def test_few_and_no_vectors(spark):
    assert run(spark, [(1, [0.0] * 4), (2, [1.0] * 4)], k=16) == by_hand([(1, [0.0] * 4), (2, [1.0] * 4)], 16, 3)
    assert run(spark, [(i, v) for i, v in enumerate(BAD)]) == []
    assert run(spark, [(i, [0.5] * 4) for i in range(20)], k=16) == by_hand([(i, [0.5] * 4) for i in range(20)], 16, 3)
