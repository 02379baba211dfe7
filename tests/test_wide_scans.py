"""Many prefixes, cursor pages, pattern tables and reads by time, against plain Python; what their plans skip."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chartdex.catalog import load
from chartdex.operators.numbering import SortKey
from chartdex.operators.patterns import contains_any, patterns_in
from chartdex.sources import paging, sinks
from chartdex.sources.prefixes import covering_ranges, scan_prefixes
from chartdex.sources.time_layout import scan_by_time, write_by_time
from tests.test_plans import plan_of


def scanned_rows(df):
    """Rows that came out of the file scans of a query that has run."""
    df.collect()
    plan, rows = df._jdf.queryExecution().executedPlan(), 0
    stack = [plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan]
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("Scan"):
            rows += node.metrics().apply("numOutputRows").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            stack.append(node.plan())
    return rows


def test_thousands_of_prefixes_of_any_length(spark):
    r = random.Random(1)
    keys = ["".join(r.choices("ab|}~é", k=r.randint(0, 9))) for _ in range(3000)]
    wanted = [k[: r.randint(1, 9)] for k in r.choices(keys, k=2000)] + ["", None, "ab", "ab", "longer than any key at all"]
    rows = spark.createDataFrame(list(enumerate(keys)), "n int, rowkey string")
    prefixes = spark.createDataFrame([(p,) for p in wanted if p != ""], "prefix string")
    found = scan_prefixes(rows, prefixes, "n")
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    distinct = {p for p in wanted if p}
    starts = {}
    for p in distinct:
        starts.setdefault(len(p), set()).add(p)
    want = {(k[:n], i) for i, k in enumerate(keys) for n, ps in starts.items() if len(k) >= n and k[:n] in ps and k[n : n + 1].encode() < b"}"}
    got = [(x["prefix"], x["n"]) for x in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    everything = scan_prefixes(rows, spark.createDataFrame([("",)], "prefix string"), "n")
    assert everything.count() == sum(k.encode() < b"}" for k in keys)
    assert scan_prefixes(rows, prefixes.where("false"), "n").count() == 0
    assert len(covering_ranges(prefixes)) <= 32


def test_a_prefix_scan_skips_what_lies_between(spark, tmp_path):
    rows = spark.range(200_000).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("rowkey"), (F.col("id") * 2).alias("v"))
    sinks.write_by_key(rows, str(tmp_path / "keyed"))
    stored = spark.read.parquet(str(tmp_path / "keyed"))
    wanted = spark.createDataFrame([("0000012",), ("001999",), ("00199999",)], "prefix string")
    found = scan_prefixes(stored, wanted, "v")
    assert found.count() == 10 + 100 + 1
    assert scanned_rows(found) < 200_000
    assert "PushedFilters: [Or(" in plan_of(found)


def test_all_pages_are_one_numbering(spark, sf_dir):
    rows = [(i, None if i % 6 == 0 else i * 7 % 11) for i in range(100)]
    index = spark.createDataFrame(rows, "id long, g int").repartition(3)
    sort = [SortKey(F.col("g"), ascending=False)]
    whole = [r["id"] for r in index.orderBy(F.col("g").desc_nulls_last(), "id").collect()]
    for size in (1, 7, 100, 101):
        got = {r["id"]: r["page"] for r in paging.all_pages(index, [], sort, ["id"], size).collect()}
        assert got == {i: n // size for n, i in enumerate(whole)}
    assert paging.all_pages(index.where("false"), [], sort, ["id"], 5).count() == 0
    # a page more is no scan more
    assert "Union" not in plan_of(load()[0]["search_index_pages"](spark, sf_dir))


@pytest.mark.parametrize("ascending, nulls_first", [(True, None), (True, False), (False, None), (False, True)])
def test_pages_give_every_match_once(spark, ascending, nulls_first):
    rows = [(i, None if i % 6 == 0 else i * 7 % 11, float("nan") if i % 9 == 0 else None if i % 4 == 0 else i % 3 / 2) for i in range(100)]
    index = spark.createDataFrame(rows, "id long, g int, x double").repartition(3)
    sort = [SortKey(F.col("g"), ascending, nulls_first), SortKey(F.col("x"), False)]
    whole = index.orderBy(*[k.order() for k in sort], "id").collect()
    for size in (1, 7, 50, 100, 101):
        pages = list(paging.search_pages(index.where("id < 20") if size == 1 else index, [], sort, ["id"], size))
        got = [r["id"] for page in pages for r in page]
        assert got == [r["id"] for r in whole if size > 1 or r["id"] < 20]
        assert all(len(p) == size for p in pages[:-1])
    page = paging.search_after(index, [], sort, ["id"], 7, pages[0][10][paging.CURSOR])
    assert "TakeOrderedAndProject(limit=7" in plan_of(page)
    assert list(paging.search_pages(index.where("false"), [], sort, ["id"], 5)) == []


def test_a_page_tells_the_scan_where_it_begins(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumnRenamed("o_orderkey", "id")
    first = paging.search_after(orders, [], ["o_custkey"], ["id"], 100).collect()
    second = paging.search_after(orders, [], ["o_custkey"], ["id"], 100, first[-1][paging.CURSOR])
    assert "PushedFilters: [IsNotNull(o_custkey), GreaterThanOrEqual(o_custkey," in plan_of(second)


def test_a_hundred_thousand_patterns(spark):
    r = random.Random(4)
    texts = ["".join(r.choices("abcdefghijklmnop é", k=r.randint(0, 300))) for _ in range(300)] + [None, ""]
    patterns = ["".join(r.choices("abcdefghijklmnop", k=r.randint(4, 9))) for _ in range(100_000)]
    patterns += [t[a : a + 12] for t in texts[:100] if t for a in (3, 20)] + ["é", "zz", None, "p é", " "]
    table = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    listed = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    found = patterns_in(table, listed, "body")
    assert "NestedLoop" not in plan_of(found)
    distinct = {p for p in patterns if p is not None}
    sizes = {len(p) for p in distinct}
    want = set()
    for i, t in enumerate(texts):
        if t is not None:
            want |= {(i, p) for p in {t[a : a + n] for n in sizes for a in range(len(t) - n + 1)} & distinct}
    got = [(x["id"], x["pattern"]) for x in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    rows = contains_any(table, listed, "body")
    assert rows.columns == ["id", "body"] and {x["id"] for x in rows.collect()} == {i for i, _ in want}
    with_empty = contains_any(table, spark.createDataFrame([("",)], "pattern string"), "body")
    assert with_empty.count() == sum(t is not None for t in texts)
    assert contains_any(table, listed.where("false"), "body").count() == 0


@pytest.mark.parametrize("kind", ["string", "date", "timestamp"])
def test_old_years_are_not_in_the_scan(spark, tmp_path, kind):
    days = spark.range(4000).select("id", F.date_add(F.lit("1995-01-01").cast("date"), F.col("id").cast("int")).cast(kind).alias("at"))
    if kind == "string":
        days = days.unionByName(spark.createDataFrame([(-1, "n/a"), (-2, ""), (-3, "19"), (-4, "200"), (-5, "2004")], "id long, at string"))
    days = days.unionByName(spark.range(9001, 9002).select("id", F.lit(None).cast(kind).alias("at")))
    write_by_time(days, str(tmp_path / kind), "at")
    found = scan_by_time(spark, str(tmp_path / kind), "at", as_of=dt.date(2004, 3, 31))
    start = "2003" if kind == "string" else F.lit("2003-01-01").cast(kind)
    assert {r["id"] for r in found.collect()} == {r["id"] for r in days.where(F.col("at") >= start).collect()}
    assert found.columns == ["id", "at"]
    assert "PartitionFilters: [isnotnull(year_of_time" in plan_of(found)
    assert scanned_rows(found) < 1200
