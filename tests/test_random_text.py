"""Text expressions against plain Python on random short texts of awkward characters."""

import random

import pytest
from pyspark.sql import functions as F

from chartdex.functions import blank, dates, keys, text
from chartdex.operators import filters
from chartdex.operators.filters import FilterSpec

SIZE = 1500
JAVA_SPACES = set("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f     　") | {chr(c) for c in range(0x2000, 0x200B) if c != 0x2007}


def texts(alphabet, longest, seed):
    rng = random.Random(seed)
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(SIZE)]
    return made + [None, ""]


def check(spark, values, column, expected):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    got = {r["i"]: r["v"] for r in rows.select("i", column.alias("v")).collect()}
    for i, s in enumerate(values):
        assert got[i] == expected(s), repr(s)


def is_blank(s):
    return s is None or all(c in JAVA_SPACES for c in s)


def test_blank(spark):
    check(spark, texts(" \t\n　\xa0  ax", 3, 1), blank.is_blank("s"), is_blank)


@pytest.mark.parametrize("start, end", [(-4, 0), (-4, -1), (-2, -1), (0, 4), (1, 3), (0, 0), (2, -1), (-3, 2)])
def test_salt(spark, start, end):
    def expected(s):
        if s is None:
            return None
        if start < 0 and end <= 0:
            low, high = len(s) + start, len(s) + end
            return s[low:high][::-1] if low >= 0 and high > 0 else "zzzz"
        if 0 <= start <= end:
            return s[start:end][::-1] if end <= len(s) else "zzzz"
        return "zzzz"

    check(spark, texts("0123中é", 7, 2), keys.salt("s", start, end), expected)


def test_own_prefix_range(spark):
    def expected(s):
        if s is None:
            return None
        parts = s.split("|")
        if len(parts) < 4:
            return False
        prefix = "|".join(parts[:3]) + "|"
        return prefix.encode() <= s.encode() < (prefix + "}").encode()

    check(spark, texts("a||}~|é1", 9, 3), keys.in_own_prefix_range("s"), expected)


@pytest.mark.parametrize("separator", [",", "|", ".*", " ", "\\", "ab"])
def test_split_list(spark, separator):
    def expected(s):
        if s is None or s == "":
            return None if s is None else []
        return [p for p in s.split(separator) if not is_blank(p)] if separator in s else [s]

    values = texts(["a", "b", " ", "　", separator], 8, 4)
    check(spark, values, text.split_list("s", separator), expected)
    check(spark, values, text.split_list_distinct("s", separator), lambda s: expected(s) and list(dict.fromkeys(expected(s))))


@pytest.mark.parametrize("item, kv", [(",", ":"), ("|", "="), ("; ", ".")])
def test_split_map(spark, item, kv):
    def expected(s):
        if s is None:
            return None
        pairs = [p.split(kv) for p in s.split(item) if kv in p]
        return {p[0]: p[1] for p in pairs}

    check(spark, texts(["a", "b", " ", item, kv], 12, 5), text.split_map("s", item, kv), expected)


def test_age_text_to_days(spark):
    def number(s):
        if s.count(".") > 1 or not s.strip("."):
            return None
        return float(s)

    def expected(s):
        if is_blank(s):
            return -1.0
        rest = s.replace(" ", "").replace("年", "岁").replace("日", "天")
        days = 0.0
        for unit, size in (("岁", 365), ("月", 30), ("天", 1)):
            last = None
            while True:
                head = rest[: len(rest) - len(rest.lstrip("0123456789."))]
                if not rest[len(head) :].startswith(unit):
                    break
                last, rest = head, rest[len(head) + 1 :]
            if last is not None:
                if number(last) is None:
                    return None
                days += number(last) * size
        return days

    check(spark, texts("13.岁年月天日 约", 7, 6), dates.age_text_to_days("s"), expected)


@pytest.mark.parametrize("op", ["like", "nlike", "inlike", "in", "nin", "sw", "ew", "=", "<>", ">", "<=", "isnull", "notnull"])
def test_filters(spark, op):
    value = "a,b%,_"
    parts = value.split(",")
    tests = {
        "like": lambda s: value in s,
        "nlike": lambda s: value not in s,
        "inlike": lambda s: any(p in s for p in parts),
        "in": lambda s: s in parts,
        "nin": lambda s: s not in parts,
        "sw": lambda s: any(s.startswith(p) for p in parts),
        "ew": lambda s: any(s.endswith(p) for p in parts),
        "=": lambda s: s == value,
        "<>": lambda s: s != value,
        ">": lambda s: s.encode() > value.encode(),
        "<=": lambda s: s.encode() <= value.encode(),
        "notnull": lambda s: True,
    }
    values = texts("ab%_,\\", 4, 7) + [value, "中"]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    got = {r["i"] for r in filters.filter_rows(rows, FilterSpec("s", op, value)).collect()}
    want = {i for i, s in enumerate(values) if (s is None if op == "isnull" else s is not None and tests[op](s))}
    assert got == want


def test_visit_row_key(spark):
    rng = random.Random(8)
    parts = [[rng.choice(["p", " ", None, "E123", "12345"]) for _ in range(4)] for _ in range(300)]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(parts)], "i int, a string, b string, c string, d string")
    got = {r["i"]: r["v"] for r in rows.select("i", keys.visit_rowkey("a", "b", "c", "d", "9").alias("v")).collect()}
    for i, (pid, kind, vid, eid) in enumerate(parts):
        whole = not any(map(is_blank, (pid, kind, vid, eid))) and len(eid) >= 4
        assert got[i] == (f"{eid[-4:][::-1]}|9|{eid}|{kind}|{vid}|{pid}" if whole else None)


def test_mojibake_round_trip(spark):
    values = [s for s in texts("aé中😀 ", 6, 9) if s]
    rows = spark.createDataFrame([(s,) for s in values], "s string")
    spoiled = F.decode(F.encode("s", "UTF-8"), "ISO-8859-1")
    assert rows.where(text.fix_mojibake(spoiled) != F.col("s")).count() == 0
