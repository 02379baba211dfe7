"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names for every operator."""

import hashlib
import sys
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartdex.llm import language_id, line_dedup, lm_score, mixing, near_dedup, nearest, quality, sharding

# extra columns whose names clash with those the operators work with
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, r1 long, h1 long, n string, doc string, node long, id long"
LONG = "long text of words " * 20_000
ROWS = [
    (1, "a b c d e f\nsame line\n", "en", "s1"),
    (2, None, "en", "s1"),
    (3, "", None, None),
    (4, " \t\n ", "fr", "s2"),
    (5, LONG, "fr", "s2"),
    (6, "a b c d e f\nsame line\n", "en", None),
    (6, "a b c d e f\nsame line\n", "en", None),
    (7, "été où ça é\nÉ", None, "é"),
    (None, "no id here at all", "en", "s1"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, None if r[1] is None else len(r[1]), 7, 1, 2, "x", "y", 3, 4) for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_line_dedup(docs, empty):
    got = line_dedup.dedup_lines(docs, min_docs=3, batches=4, fanout=2).collect()
    texts = sorted((str(r["doc"]["doc_id"]), r["kept_text"], r["n_lines"], r["n_dropped"]) for r in got)
    want = []
    for i, text, *_ in ROWS:
        lines = (text or "").split("\n")
        kept = [x for x in lines if x.strip(" \t").lower() not in ("a b c d e f", "same line")]
        want.append((str(i), "\n".join(kept), len(lines), len(lines) - len(kept)))
    assert texts == sorted(want)
    assert got[0]["doc"]["h1"] == 2
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_runs_are_merged_and_count_once_per_document(spark):
    rows = [(i, "x\nX \nonly %d" % i) for i in range(9)] + [(100, "x"), (101, "often\noften\noften")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for batches, fanout in ((1, 3), (5, 2), (9, 3)):
        got = {r["doc"]["doc_id"]: r["n_dropped"] for r in line_dedup.dedup_lines(docs, 10, batches=batches, fanout=fanout).collect()}
        assert got == {**{i: 2 for i in range(9)}, 100: 1, 101: 0}


def test_mixing(docs, empty):
    got = mixing.mix_documents(docs).collect()
    assert len(got) == len(ROWS)
    assert all(0 <= r["copies"] <= 3 for r in got)
    assert sum(r["target"] for r in {(r["source_size"], r["target"]): r for r in got}.values()) > 0
    again = mixing.mix_documents(docs).collect()
    key = lambda r: (str(r["doc_id"]), r["r1"], r["size"], r["copies"], r["target"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    repeated = mixing.repeat_documents(docs, mixing.mix_documents(docs))
    assert repeated.columns == docs.columns
    assert repeated.count() == sum(r["copies"] for r in got)
    assert mixing.mix_documents(empty).count() == 0


def test_mix_meets_its_targets(spark):
    n = F.col("id")
    rows = spark.range(6000).select(
        n.alias("doc_id"),
        F.repeat(F.lit("w "), (n % 97 + 1).cast("int")).alias("text"),
        F.when(n % 3 == 0, "hot").when(n % 50 == 1, "tiny").otherwise(F.concat(F.lit("s"), (n % 7).cast("string"))).alias("source"),
    )
    got = mixing.mix_documents(rows).join(rows.select("doc_id", "source"), "doc_id")
    per = got.groupBy("source").agg(F.first("target").alias("t"), F.first("source_size").alias("s"), F.sum(F.col("size") * F.col("copies")).alias("w"))
    found = {r["source"]: r for r in per.collect()}
    total = sum(r["s"] for r in found.values())
    # water filling by hand
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(found))}
    capped: set = set()
    while True:
        level = (total - sum(3 * found[s]["s"] for s in capped)) / sum(w for s, w in weight.items() if s not in capped)
        new = {s for s in found if s not in capped and level * weight[s] > 3 * found[s]["s"]}
        if not new:
            break
        capped |= new
    for s, r in found.items():
        want = 3 * r["s"] if s in capped else level * weight[s]
        assert abs(r["t"] - want) < 1e-6 * want
        assert abs(r["w"] - want) <= 100


@pytest.mark.parametrize("lengths", [(1e200, 1e200), (1e-170, 1e-170), (1e200, 1e-200), (1e150, 1e-3), (1.5e308, 5e-324)])
def test_nearest_of_extreme_lengths(spark, lengths):
    """Squares beyond the range of doubles: every query has its results, by the products in double precision."""
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, (60, 4))
    x[::2] *= lengths[0]
    x[1::2] *= lengths[1]
    x = np.where((x == 0).all(axis=1)[:, None], lengths[1], x)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = nearest.nearest_neighbours(table, F.col("vec_id") % 20 == 0, k=5, list_size=10).collect()
    assert sorted((r["query_id"], r["rank"]) for r in found) == [(q, k) for q in (0, 20, 40) for k in range(1, 6)]
    for r in found:
        terms = [Fraction(float(a)) * Fraction(float(b)) for a, b in zip(x[r["query_id"]], x[r["vec_id"]])]
        true, bound = sum(terms), Fraction(sys.float_info.max)
        if abs(true) > bound:
            assert r["score"] == (np.inf if true > 0 else -np.inf)
        else:
            assert abs(Fraction(r["score"]) - true) <= sum(map(abs, terms)) / 10**15 + Fraction(5e-323)


def test_near_dedup(docs, empty):
    got = near_dedup.near_duplicates(docs, shingle=3, percent=85)
    found = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in got.collect())
    want = [("1", 6, "1", True), ("2", 0, "2", True), ("3", 0, "3", True), ("4", 0, "4", True), ("5", 4, "5", True)]
    want += [("6", 6, "1", False)] * 2 + [("7", 3, "7", True), ("None", 3, "None", True)]
    assert found == sorted(want)
    assert near_dedup.near_duplicates(empty).count() == 0
    kept = near_dedup.drop_near_duplicates(docs, shingle=3, percent=85)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "7", "None"])


def test_near_dedup_without_ids(spark):
    """Documents without an id link others, and of those that have only such links one stays."""
    base = [f"w{i}" for i in range(200)]

    def text(*changed):
        return " ".join("x" + w if i in changed else w for i, w in enumerate(base))

    def groups(rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in near_dedup.near_duplicates(docs, 3, 85).collect())
        kept = near_dedup.drop_near_duplicates(docs, shingle=3, percent=85).collect()
        return got, sorted(str(r["doc_id"]) for r in kept)

    one, bridge, two = text(*range(10)), text(), text(*range(100, 110))  # one and two are linked with the bridge only
    assert groups([(None, one), (None, bridge), (3, two)]) == ([("3", "3", True), ("None", "3", False), ("None", "3", False)], ["3"])
    assert groups([(7, one), (None, bridge), (9, two)]) == ([("7", "7", True), ("9", "7", False), ("None", "7", False)], ["7"])
    got, kept = groups([(None, one), (None, bridge), (None, bridge), (None, two), (4, "quite another text")])
    assert kept == ["4", "None"] and [c for i, c, _ in got] == ["4", "None", "None", "None", "None"]
    assert groups([((1 << 62) + 5, one), (None, bridge), (-9, two)])[1] == ["-9"]


def test_quality(docs, empty):
    got = {str(r["doc"]["doc_id"]): r for r in quality.quality_ledger(docs).collect()}
    assert len(got) == 8 and got["2"]["n_words"] == got["3"]["n_words"] == 0
    assert got["5"]["n_words"] == got["5"]["n_repeat_words"] == 80_000
    assert got["7"]["word_chars"] == 9 and got["7"]["n_dup_lines"] == 0
    assert quality.quality_ledger(empty).count() == 0
    ledger = quality.quality_ledger(docs)
    alone = {r["rule"]: (r["n_failed"], r["n_only_this"]) for r in quality.ablation(ledger, "v1").collect()}
    assert alone["few_words"] == (8, 3) and alone["repeated_windows"] == (1, 1)


def test_sharding(docs, empty):
    got = sharding.shard_documents(docs, shards=8).collect()
    assert len(got) == len(ROWS)
    shards = {}
    for r in got:
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert len({r["shard"] for r in got if r["doc_id"] in (1, 6)}) == 1  # equal texts
    assert len({r["shard"] for r in got if r["doc_id"] in (2, 3)}) == 1  # null and empty
    assert sharding.shard_documents(empty).count() == 0


@pytest.mark.parametrize("shards", [1, 2, 3, 8])
def test_smallest_capacity_against_brute_force(shards):
    import random

    rng = random.Random(shards)
    for _ in range(200):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 40))]
        keys = sorted(rng.sample(range(1 << 12), len(sizes)))
        ranges: dict = {}
        for k, s in zip(keys, sizes):
            ranges.setdefault(k >> 8, []).append((k << 52 if k < 1 << 11 else (k - (1 << 12)) << 52, 0, s))
        order = sorted(ranges.items(), key=lambda x: x[1][0][0])
        borders = sharding.GroupBorders([(i, sum(g[2] for g in gs)) for i, (_, gs) in enumerate(order)])
        for i, (_, gs) in enumerate(order):
            borders.add(i, gs)
        flat = [g[2] for _, gs in order for g in sorted(gs)]

        def greedy(capacity):
            used, room = 1, capacity
            for s in flat:
                if s > room:
                    used, room = used + 1, capacity
                room -= s
            return used <= shards

        best = next(c for c in range(max(flat), sum(flat) + 1) if greedy(c))
        assert sharding.smallest_capacity(borders, shards, max(flat)) == best
        cuts = [0, *sharding.cut_positions(borders, shards, best), borders.total]
        assert cuts == sorted(cuts) and max(b - a for a, b in zip(cuts, cuts[1:])) <= best


def test_language_id(docs, empty):
    got = {str(r["doc_id"]): r for r in language_id.identify_languages(docs).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in ("2", "3", "4"))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language_id.identify_languages(empty).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify_languages(unlabelled).collect()} == {"und"}


def test_lm_score(docs, empty):
    got = lm_score.score_documents(docs).collect()
    assert len(got) == len(ROWS)
    by_id = {str(r["doc_id"]): r for r in got}
    assert by_id["2"]["n_tokens"] == by_id["4"]["n_tokens"] == 1 and by_id["5"]["n_tokens"] == 80_001
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in got)
    assert lm_score.score_documents(empty).count() == 0


def test_nearest(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20 * i + j, [float(i), float(j), 1.0], "x") for i in range(5) for j in range(4)]
    rows += [(200, None, "x"), (220, [], "x"), (240, [0.0, 0.0, 0.0], "x"), (260, [nan, 1.0, 1.0], "x"), (280, [inf, 0.0, 1.0], "x")]
    rows += [(300, [1.0, None, 2.0], "x"), (320, [1.0, 2.0], "x"), (40, [2.0, 0.0, 1.0], "x"), (None, [1.0, 1.0, 1.0], "x")]
    rows += [(1000 + i, [3.0, 3.0, 1.0], "x") for i in range(30)]  # ties
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key string")
    got = nearest.nearest_neighbours(vectors, F.pmod("vec_id", F.lit(20)) == 0, k=7).collect()
    good = {(i, tuple(v)) for i, v, _ in rows if i is not None and i < 200 or i is not None and i >= 1000}
    for q, v in sorted(x for x in good if x[0] % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:7]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert mine == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert {r["query_id"] for r in got} == {i for i, _ in good if i % 20 == 0}
    assert nearest.nearest_neighbours(vectors.where("false"), F.lit(True)).count() == 0
    one = vectors.where("vec_id = 20")
    assert nearest.nearest_neighbours(one, F.lit(True)).count() == 0


def test_kept_text_hash(docs):
    got = line_dedup.dedup_lines(docs, min_docs=100).select("doc.text", "kept_text").collect()
    digest = lambda s: hashlib.sha256((s or "").encode()).hexdigest()
    assert all(digest(r["text"]) == digest(r["kept_text"]) for r in got)


@pytest.mark.parametrize("pieces", [1, 1024])
def test_texts_without_candidates_stay_out_of_the_shuffle(spark, monkeypatch, pieces):
    monkeypatch.setattr(near_dedup, "PIECES", pieces)
    rows = spark.range(100_000).select(F.xxhash64("id").alias("r1"), "id")
    keys = rows.where("id % 20 = 0").select("r1")
    found = near_dedup._likely(rows, keys, "r1", 5000)
    ids = {r["id"] for r in found.collect()}
    assert found.columns == rows.columns and ids >= set(range(0, 100_000, 20))
    assert len(ids) < (13_000 if pieces > 1 else 25_000)
    assert near_dedup._likely(rows, keys.where("false"), "r1", 0).count() == 0
