"""Passage removal against sets of windows; the merge against sorting."""

import hashlib
import random
from collections import Counter

import pytest

from chartdex.llm import passages

SCHEMA = "doc_id long, text string, q long, t1 string, spans long"


def by_hand(texts, length):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        spans = []
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + length
                else:
                    spans.append([p, p + length])
        covered = {i for a, b in spans for i in range(a, b)}
        kept = bytes(b for i, b in enumerate(t) if i not in covered)
        out.append((len(t), len(covered), [tuple(s) for s in spans], hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, texts, length, ids=None):
    rows = [(i if ids is None else ids[i], t, 1, "x", 2) for i, t in enumerate(texts)]
    found = passages.remove_passages(spark.createDataFrame(rows, SCHEMA).repartition(4), length)
    columns = lambda r: (r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], r["kept_sha256"])
    return sorted((str(r["doc_id"]), columns(r)) for r in found.collect())


@pytest.fixture(params=[(64, 8, 16, 32), (1000, 16, 60, 20)])
def small_parts(request, monkeypatch):
    for name, size in zip(("RUN", "BLOCK", "RANGE", "BATCH"), request.param):
        monkeypatch.setattr(passages, name, size)


@pytest.mark.parametrize("length, letters", [(10, "ab"), (33, "aaab"), (60, "abcdé ñ\n")])
def test_random_texts(spark, small_parts, length, letters):
    r = random.Random(length)
    pool = ["".join(r.choice(letters) for _ in range(r.randint(5, 4 * length))) for _ in range(8)]
    texts = []
    for _ in range(120):
        text = "".join(r.choice(pool) if r.random() < 0.5 else "".join(r.choices(letters, k=r.randint(1, length))) for _ in range(r.randint(0, 6)))
        if text and r.random() < 0.4:
            at = r.randrange(len(text))
            text = text[:at] + "Z" + text[at + 1 :]
        texts.append(text)
    texts += [texts[3]] * 4 + ["", None]
    want = by_hand(texts, length)
    assert sum(w[1] for w in want) > 0
    assert run(spark, texts, length) == sorted((str(i), w) for i, w in enumerate(want))


def test_a_passage_in_a_third_of_all_rows(spark, small_parts):
    r = random.Random(5)
    word = lambda n: "".join(r.choices("abcdefghij", k=n))
    passage = word(90)
    texts = [word(50) + (passage if i % 3 == 0 else word(20)) + word(60) for i in range(300)]
    got = run(spark, texts, 40)
    assert got == sorted((str(i), w) for i, w in enumerate(by_hand(texts, 40)))
    assert all(g[1][1] >= 90 for g in got if int(g[0]) % 3 == 0)


def test_long_texts_are_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(passages, "CHUNK", 700)
    r = random.Random(1)
    text = "".join(r.choices("abcdefgh ", k=5000))
    texts = [text, "x" * 3000, text[1000:1400] + "-" + text[600:660], "yz" * 40]
    assert run(spark, texts, 60) == sorted((str(i), w) for i, w in enumerate(by_hand(texts, 60)))


def test_repeated_ids_and_rows_and_no_rows(spark):
    texts = ["abcdefghijkl", "abcdefghijkl", "abcdefghijkm", "short", None]
    got = run(spark, texts, 12, ids=[1, 1, None, 2, 2])
    assert got == sorted(zip(["1", "1", "None", "2", "2"], by_hand(texts, 12)))
    assert passages.remove_passages(spark.createDataFrame([], SCHEMA), 12).count() == 0


def test_the_merge_sorts_and_knows_shared_prefixes():
    r = random.Random(2)
    for runs in (1, 2, 5, 9):
        streams, everything = [], []
        for _ in range(runs):
            keys = sorted({bytes(r.choices(b"ab", k=r.randint(1, 90))) for _ in range(r.randint(0, 40))})
            everything += keys
            shared = [passages.shared_prefix(a, b, 0) for a, b in zip([b"", *keys], keys)]
            streams.append(iter(list(zip(shared, keys, keys))))
        got = list(passages.merged(streams))
        assert [k for k, _, _ in got] == sorted(everything)
        for (a, _, _), (b, known, _) in zip(got, got[1:]):
            assert known == passages.shared_prefix(a, b, 0)
