"""Packing: every piece once, no bin over its capacity, no overlap, small edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from chartdex.llm.packing import pack_documents, plan_bins


def check_plan(histogram, capacities):
    plan = plan_bins(histogram, capacities)
    bins = {}
    seen = dict.fromkeys(histogram, 0)
    for length, first, n, per_bin, start_bin, offset in plan.entries:
        assert first == seen[length]
        seen[length] += n
        for j in range(n):
            bins.setdefault(start_bin + j // per_bin, []).append((offset + j % per_bin * length, length))
    assert seen == histogram
    assert sorted(bins) == list(range(plan.n_bins))
    starts = [s for s, _ in plan.ranges]
    for b, held in bins.items():
        capacity = [c for s, c in plan.ranges if s <= b][-1]
        held.sort()
        assert held[0][0] == 0
        for (a, size), (nxt, _) in zip(held, held[1:]):
            assert a + size == nxt
        used = held[-1][0] + held[-1][1]
        assert used <= capacity
        assert capacity == min(c for c in capacities if c >= used)
    assert starts == sorted(starts)
    return plan, bins


@pytest.mark.parametrize("seed", range(30))
def test_random_histograms(seed):
    rng = random.Random(seed)
    capacities = tuple(sorted(rng.sample(range(1, 60), rng.randint(1, 4))))
    most = max(capacities)
    histogram = {rng.randint(1, most): rng.randint(1, 40) for _ in range(rng.randint(1, 25))}
    check_plan(histogram, capacities)


def test_tight_fit():
    plan, _ = check_plan({5: 10, 3: 10, 2: 10}, (10,))
    assert plan.n_bins == 11  # 5+5 five times, 3+3+3 three times, 3+2+2+2, and seven 2s in two bins


def test_plan_size_does_not_follow_the_counts():
    rng = random.Random(1)
    small = {length: rng.randint(1, 9) for length in range(1, 513)}
    large = {length: n * 100_000 for length, n in small.items()}
    assert len(plan_bins(large, (128, 256, 512)).entries) < 40 * 512


def test_documents(spark):
    rows = [(1, "a b c", "x"), (2, None, "x"), (3, "", "x"), (4, "w " * 25, "y"), (4, "w " * 25, "y"), (None, "q", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = pack_documents(docs, (4, 10)).collect()
    assert len(got) == 4 + 2 * 3
    assert all(r["bin_id"] is None and r["bin_capacity"] is None for r in got if r["length"] == 0)
    places = [(r["bin_id"], r["bin_start"] + k) for r in got if r["length"] for k in range(r["length"])]
    assert len(places) == len(set(places)) == 3 + 50 + 1
    assert all(r["bin_start"] + r["length"] <= r["bin_capacity"] for r in got if r["length"])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(docs).count() == 0


def test_given_lengths(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"), (F.col("id") % 7).alias("n"))
    got = pack_documents(docs, (8, 16), length_col="n")
    assert got.agg(F.sum("length")).first()[0] == sum(i % 7 for i in range(100))
