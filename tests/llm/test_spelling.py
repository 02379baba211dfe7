"""Spelling variants against all pairs of a vocabulary."""

import random
import re
import zlib
from collections import Counter

import pytest

from chartdex.llm import spelling
from chartdex.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, word string, n long, list long"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def by_hand(docs, min_length=7, ratio=10):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 31 == 0 and i is not None:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2 and len(w) >= min_length}
    others = {w: [] for w in words}
    by_size = sorted(words, key=len)
    for i, a in enumerate(by_size):
        for b in by_size[i + 1 :]:
            if len(b) > len(a) + 1:
                break
            if near(a, b):
                others[a].append(b)
                others[b].append(a)
    form = {}
    for w, n in words.items():
        best = min(others[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(others[w]), form[w], words.get(form[w]), root))
    return sorted(out)


def run(df, **options):
    return sorted((tuple(r) for r in spelling.group_spellings(df, **options).select("word", "n", "n_near", "form", "form_n", "root").collect()))


@pytest.mark.parametrize("bits", [15, 4])
def test_random_words(spark, monkeypatch, bits):
    monkeypatch.setattr(spelling, "DICTIONARY_BITS", bits)
    monkeypatch.setattr(spelling, "HELD", 50)
    r = random.Random(bits)
    base = ["".join(r.choices("abÉé", k=r.randint(6, 10))) for _ in range(60)]
    docs = [(i, " ".join(r.choices(base, weights=[1 / (j + 1) ** 2 for j in range(60)], k=r.randint(0, 40)))) for i in range(150)]
    docs += [(None, docs[0][1]), (3, None), (4, ""), docs[5], docs[5], (9, "1234567 abcdefg-ABCDEFG_éééÉééé×÷ " * 30)]
    df = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], SCHEMA).repartition(5)
    assert run(df) == by_hand(docs)


def test_forms_lead_to_roots(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 30, "aaaaabb": 400, "aaaabbb": 5000, "zzzzzzz": 2}
    docs = spark.createDataFrame([(None, f"{w} " * n, "x", 1, 2) for w, n in words.items()], SCHEMA)
    got = {w[0]: w[1:] for w in run(docs)}
    assert got["aaaaaaa"] == (2, 1, "aaaaaab", 30, "aaaabbb")
    assert got["aaaabbb"] == (5000, 1, None, None, "aaaabbb")
    assert got["zzzzzzz"] == (2, 0, None, None, "zzzzzzz")
    assert run(docs.where("false")) == []


def test_near_words_share_a_list():
    r = random.Random(3)
    for _ in range(300):
        word = "".join(r.choices("abc", k=r.randint(7, 12)))
        frequent = {"".join(r.choices("^abc$", k=r.randint(2, 4))): r.randint(5, 9) for _ in range(r.randint(0, 60))}
        loses, gains = (set(x) for x in spelling.lists_of(word, frequent))
        for i in range(len(word)):
            assert loses & set(spelling.lists_of(word[:i] + "z" + word[i + 1 :], frequent)[0])
            assert loses & set(spelling.lists_of(word[:i] + word[i + 1 :], frequent)[1])
        for i in range(len(word) + 1):
            assert gains & set(spelling.lists_of(word[:i] + "c" + word[i:], frequent)[0])


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in QUERIES["op13_spelling_variants"](spark, sf_dir).select("word", "n", "n_near", "form", "form_n", "root").collect())
    assert got == by_hand([tuple(d) for d in docs])
