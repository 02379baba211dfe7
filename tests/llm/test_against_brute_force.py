"""Queries over the given tables against brute force, plain SQL, or held-out accuracy."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chartdex.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


def rows_of(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir).collect()


def tokens(text):
    return WORD.findall((text or "").translate(UPPER))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, duck, sf_dir, name):
    from tests.compare import problem

    def widened(spark, sf_dir):
        df = QUERIES[name](spark, sf_dir)
        return df.withColumns({c: df[c].cast("bigint") for c, kind in df.dtypes if kind == "int"})

    assert problem(spark, duck, sf_dir, widened, ORACLES[name]) is None


def groups_by_brute_force(rows, size, percent):
    """{id: (set size, smallest connected id)} from all pairs that share a shingle."""
    sets = {}
    for i, text in rows:
        w = tokens(text)
        k = min(size, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i in sorted(sets):
        near = Counter(j for s in sets[i] for j in holders[s])
        for j, common in near.items():
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_duplicates(spark, sf_dir, documents):
    want = groups_by_brute_force([(r["doc_id"], r["text"]) for r in documents], 3, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows_of(spark, sf_dir, "op5_minhash_forest")}
    assert got == want
    assert any(c != i for i, (_, c) in want.items())


def test_near_duplicates_in_a_dense_region(spark):
    """A chain of copies with a few changed words each, among outliers that reach it by few links."""
    from chartdex.llm.near_dedup import near_duplicates

    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(600):
        text = list(base)
        for p in rng.choice(120, rng.integers(0, 6), replace=False):
            text[p] = f"x{rng.integers(0, 10_000)}"
        rows.append((int(i), " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs, 3, 85).collect()}
    assert got == groups_by_brute_force(rows, 3, 85)


def test_all_neighbours_of_a_dense_region_meet(spark):
    """Every two of nine classes share an order's window, so none may be left out for closer ones."""
    from chartdex.llm.near_dedup import DEEP, HASHES, WIDE, candidate_pairs
    from chartdex.llm.shared import Workspace

    rows = []
    for i in range(9):
        sig = np.arange(HASHES, dtype=np.uint16)
        sig[10 * i : 10 * i + i] += 1
        rows.append((i, i, 100, bytearray(sig.tobytes())))
    classes = spark.createDataFrame(rows, "node long, grp long, n long, sig binary")
    work = Workspace(spark, "test")
    for name, forest in (("wide", WIDE), ("deep", DEEP)):
        found = candidate_pairs(work, classes, 80, forest, 8, name).select("a", "b").collect()
        assert {tuple(r) for r in found} == {(a, b) for a in range(9) for b in range(a + 1, 9)}


def test_profiles_rule_out_no_pair_at_the_threshold():
    from chartdex.llm.near_dedup import profile, within_reach

    rng = np.random.default_rng(11)
    ruled_out = 0
    for size in (1, 2, 7, 30, 150, 900, 20_000):
        for _ in range(60):
            pool = rng.integers(0, 1 << 64, 2 * size, dtype=np.uint64)
            common = size - rng.integers(0, size // 3 + 1)
            a, b = pool[:size], np.r_[pool[:common], pool[size : 2 * size - common - rng.integers(0, 2)]]
            i, n = len(np.intersect1d(a, b)), len(a) + len(b)
            may = within_reach(profile(a)[:, None], profile(b)[:, None], np.array([n]), 85)[0]
            assert may or 100 * i < 85 * (n - i)
            ruled_out += not may
    assert ruled_out > 50


def test_dense_region_of_different_texts_is_hardly_compared(spark, monkeypatch):
    """Texts around one base, all below the threshold: neighbours in most orders, links in none."""
    from chartdex.llm import near_dedup

    rng = np.random.default_rng(6)
    rows = []
    for i in range(300):
        text = [f"w{k}" for k in range(150)]
        for p in range(rng.integers(0, 18), 150, 18):
            text[p] = f"x{rng.integers(0, 100_000)}"
        rows.append((i, " ".join(text)))
    compared, confirm = [], near_dedup._confirmed

    def confirmed(pairs, sets, percent):
        compared.append(pairs.count())
        return confirm(pairs, sets, percent)

    monkeypatch.setattr(near_dedup, "_confirmed", confirmed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs, 3, 85).collect()}
    assert got == groups_by_brute_force(rows, 3, 85)
    assert sum(compared) < 4 * len(rows)


def test_nearest_neighbours_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in table])
    x = np.array([r["embedding"] for r in table], dtype=np.float64)
    got = defaultdict(list)
    for r in sorted(rows_of(spark, sf_dir, "op3_balanced_posting_lists"), key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = asked = 0
    for q in np.flatnonzero(ids % 20 == 0):
        near = x @ x[q]
        near[q] = -np.inf
        best = ids[np.lexsort((ids, -near))[:20]]
        mine = got.pop(ids[q])
        assert [s for _, s in mine] == sorted((s for _, s in mine), reverse=True)
        hits += len(set(best) & {v for v, _ in mine})
        asked += len(best)
    assert not got and hits / asked >= 0.9


def neighbours_by_id(spark, rows, queries, k=20, **options):
    """{query: ids in the order of rank} from the index."""
    from chartdex.llm.nearest import nearest_neighbours

    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in sorted(nearest_neighbours(table, F.col("vec_id").isin(queries), k, **options).collect(), key=lambda r: r["rank"]):
        got[r["query_id"]].append(r["vec_id"])
    return got


def clustered_vectors():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 16))[rng.integers(0, 60, 6000)] + 0.4 * rng.normal(size=(6000, 16))
    return np.arange(6000), x * np.exp(0.5 * rng.normal(size=(6000, 1)))


@pytest.mark.parametrize("table, list_size", [("given", 10), ("clustered", 50)])
def test_nearest_neighbours_recall_with_many_lists(spark, sf_dir, table, list_size):
    if table == "given":
        rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
        ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)
    else:
        ids, x = clustered_vectors()
    assert len(ids) // list_size >= 50
    asked = np.flatnonzero(ids % 20 == 0)
    got = neighbours_by_id(spark, [(int(i), v.tolist()) for i, v in zip(ids, x)], ids[asked].tolist(), list_size=list_size)
    hits = 0
    for q in asked:
        near = x @ x[q]
        near[q] = -np.inf
        assert len(got[ids[q]]) == min(20, len(ids) - 1)
        hits += len(set(ids[np.lexsort((ids, -near))[:20]]) & set(got[ids[q]]))
    assert hits / (20 * len(asked)) >= 0.9


def test_query_next_to_an_empty_list_keeps_its_neighbours(spark, monkeypatch):
    from chartdex.llm import nearest

    rng = np.random.default_rng(3)
    x = np.abs(rng.normal(size=(600, 8))) * 0.1
    x[0], x[1] = -0.1, 1.0
    spot = nearest.aim(x[:1], float(np.sqrt((x**2).sum(axis=1).max())))
    plain = nearest.balanced_centroids
    monkeypatch.setattr(nearest, "balanced_centroids", lambda sample, lists: np.r_[plain(sample, lists), spot])
    got = neighbours_by_id(spark, [(i, v.tolist()) for i, v in enumerate(x)], [0, 20, 40], list_size=20)
    assert {q: len(v) for q, v in got.items()} == {0: 20, 20: 20, 40: 20}


def test_ids_with_many_vectors_leave_no_query_short(spark):
    rng = np.random.default_rng(4)
    rows = [(1, (np.ones(4) + 0.01 * rng.normal(size=4)).tolist()) for _ in range(30)]
    rows += [(i, rng.normal(size=4).tolist()) for i in range(2, 40)]
    got = neighbours_by_id(spark, rows, [1, 2], k=5)
    for q in (1, 2):
        best = defaultdict(lambda: -np.inf)
        for a in (v for i, v in rows if i == q):
            for i, v in rows:
                if i != q:
                    best[i] = max(best[i], float(np.dot(a, v)))
        assert got[q] == sorted(best, key=lambda i: (-best[i], i))[:5]


def test_languages_held_out(spark, sf_dir, documents):
    lang = {r["doc_id"]: r["lang"] for r in documents}
    right = []
    for r in rows_of(spark, sf_dir, "op8_kneser_ney_languages"):
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        if r["held_out"] and lang[r["doc_id"]] is not None and r["lang_pred"] != "und":
            right.append(r["lang_pred"] == lang[r["doc_id"]])
    assert len(right) > 20 and np.mean(right) > 0.97


def test_base_score_of_the_language_model(spark, sf_dir, documents):
    own = {r["doc_id"]: tokens(r["text"]) for r in documents}
    training = [i for i in own if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(t for i in training for t in own[i])
    total, distinct = sum(counts.values()) + len(training), len(counts) + 1
    scale = np.log10(total + 0.1 * (distinct + 1))
    for r in rows_of(spark, sf_dir, "op9_deleted_interpolation"):
        words = own[r["doc_id"]]
        base = sum(np.log10(counts[w] + 0.1) for w in words) + np.log10(len(training) + 0.1) - (len(words) + 1) * scale
        assert (r["n_tokens"], r["train_tokens"]) == (len(words) + 1, total)
        assert r["n_known"] == sum(w in counts for w in words) + 1
        assert abs(r["base_score"] - base) < 1e-8 * abs(base)
        assert r["score"] < 0


def test_spelling_model_is_a_distribution():
    from chartdex.llm.lm_score import spelling_levels
    from chartdex.llm.language_id import kneser_ney
    from chartdex.llm.ngrams import probability

    rng = np.random.default_rng(0)
    codes = np.unique(rng.integers(97, 101, (400, 5)) @ (256 ** np.arange(4, -1, -1)))
    train, held = rng.integers(0, 5, len(codes)), rng.integers(0, 3, len(codes))
    for levels in (spelling_levels(codes, train, held), kneser_ney(codes, train + held + 1)):
        for context in (codes[0] >> 8, codes[7] >> 8, 0x7A7A7A7A):
            after = (int(context) << 8) + np.arange(256)
            assert abs(probability(levels, after).sum() - 1) < 1e-9


def test_class_bigrams_are_a_distribution():
    from chartdex.llm.lm_score import class_bigrams

    rng = np.random.default_rng(0)
    codes = np.unique(rng.integers(0, 64, 30))
    table = class_bigrams(codes, rng.integers(0, 9, len(codes)), rng.integers(0, 3, len(codes)), 8)
    assert np.allclose((10**table).sum(axis=1), 1)


def test_word_hashes(spark):
    import pyarrow as pa

    from chartdex.llm.words import words_by_text, words_of

    texts = ["A b\tc é", None, "", "  \n", "x" * 3000 + " y", "b A", "ÉÉ É\x0bÉ"]
    seen = {}
    for chunk in (1 << 20, 64, 7):
        for w in words_of(pa.array(texts), True, chunk):
            for t, h, s, e in zip(w.text, w.hash, w.start, w.end):
                assert seen.setdefault(bytes(w.data[s:e]), h) == h
        got = [t for w in words_of(pa.array(texts), True, chunk) for t in w.text.tolist()]
        assert Counter(got) == {i: len(tokens(t)) for i, t in enumerate(texts) if tokens(t)}
    assert len(set(seen.values())) == len(seen)
    assert [i for i, _ in words_by_text(pa.array(texts).slice(3), True)] == [1, 2, 3]


def test_pipeline_stage_by_stage(spark, sf_dir, documents):
    """Each stage against a plain Python version on the stage's own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r["doc_id"]: r for r in documents}
    tables = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        tables[name] = docs.collect()
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf_dir}/documents.parquet')")
    kept = {r[0] for r in con.sql(f"select doc_id from ({ORACLES['op7_quality_rules']}) where kept").fetchall()}
    assert {r["doc_id"] for r in tables["quality_rules"]} == kept

    holders = Counter()
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    for i in kept:
        holders.update({key(x) for x in before[i]["text"].split("\n")} - {""})
    for r in tables["line_dedup"]:
        lines = [x for x in before[r["doc_id"]]["text"].split("\n") if holders[key(x)] < 10]
        assert r["text"] == "\n".join(lines) and r["n_chars"] == len(r["text"])

    groups = groups_by_brute_force([(r["doc_id"], r["text"]) for r in tables["line_dedup"]], 5, 80)
    assert {r["doc_id"] for r in tables["near_dedup"]} == {i for i, (_, c) in groups.items() if c == i}

    unique = {r["doc_id"]: r for r in tables["near_dedup"]}
    copies = Counter(r["doc_id"] for r in tables["mixing"])
    assert set(copies) <= set(unique) and max(copies.values()) <= 3
    sizes = {i: len(tokens(r["text"])) for i, r in unique.items()}
    total, taken = sum(sizes.values()), sum(sizes[i] * n for i, n in copies.items())
    assert abs(taken - total) < 0.1 * total

    placed = defaultdict(list)
    for r in tables["packing"]:
        if r["length"]:
            placed[r["bin_id"]].append((r["bin_start"], r["length"], r["bin_capacity"]))
    assert sum(length for b in placed.values() for _, length, _ in b) == taken
    for held in placed.values():
        held.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(held, held[1:])) and held[-1][0] + held[-1][1] <= held[-1][2]


def test_personal_data_digest(spark, sf_dir, documents):
    from chartdex.llm.personal_data import find_spans

    texts = {r["doc_id"]: r["text"] for r in documents}
    for r in rows_of(spark, sf_dir, "op6_personal_data"):
        spans = find_spans(texts[r["doc_id"]])
        assert r["spans"] == ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)
        assert r["n_email"] == sum(k == "email" for k, *_ in spans)


def test_mix_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    got = QUERIES["op2_pareto_mix"](spark, sf_dir).join(docs, "doc_id")
    per = got.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("w"), F.max("size").alias("m")).collect()
    assert all(abs(r["t"] - r["w"]) <= r["m"] for r in per)


def test_shards_are_near_equal(spark, sf_dir):
    rows = rows_of(spark, sf_dir, "op10_minimax_shards")
    sums = Counter()
    for r in rows:
        sums[r["shard"]] += r["size"]
    assert max(sums.values()) - min(sums.values()) <= 2 * max(r["size"] for r in rows)
