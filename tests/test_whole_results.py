"""Nothing lost, doubled or silently dropped: repeated and missing keys, long texts, loud failures."""

import time

import pytest
from pyspark.sql import functions as F

from chartdex.functions import dates, text
from chartdex.operators import lookups, tables
from chartdex.operators.filters import FilterSpec
from chartdex.sources import scans


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_append_idempotent_with_null_keys(spark):
    schema = "patient_id string, visit_id string, order_no string, v string"
    current = spark.createDataFrame([("p", None, "o", "stored")], schema)
    incoming = spark.createDataFrame([("p", None, "o", "again"), (None, None, None, "a"), (None, None, None, "b")], schema)
    once = tables.append_idempotent(current, incoming, ["v"])
    assert sorted(r[3] for r in rows_of(once)) == ["a", "stored"]
    assert rows_of(tables.append_idempotent(once, incoming, ["v"])) == rows_of(once)


def test_children_find_their_event_or_none(spark):
    events = spark.createDataFrame([(1, "a"), (2, None)], "pk_event_id bigint, visit_id string")
    children = spark.createDataFrame([("a", "x"), (None, "y"), ("zz", "z")], "visit_id string, order_no string")
    keyed = tables.with_event_keys(children, events, ["visit_id"])
    assert rows_of(keyed.select("pk_event_id", "order_no")) == [(1, "x"), (2, "y"), (None, "z")]
    assert rows_of(tables.without_event(keyed).select("order_no")) == [("z",)]
    stored = spark.createDataFrame([], "pk_event_id bigint, order_no string")
    with pytest.raises(Exception, match="no pk_event_id"):
        tables.append_children(stored, keyed).collect()
    twice = events.union(spark.createDataFrame([(3, "a")], events.schema))
    with pytest.raises(Exception, match="several events"):
        tables.with_event_keys(children, twice, ["visit_id"]).collect()


def test_repeated_changes_give_one_row(spark):
    current = spark.createDataFrame([("1", "a", "b")], "id string, v string, w string")
    changes = spark.createDataFrame(
        [("1", 1, "x", "y", ["v", "w"]), ("1", 2, None, "z", ["v"]), ("9", 1, "n", "m", ["w"])],
        "id string, n int, v string, w string, sets array<string>",
    )
    after = tables.partial_update(current, changes, order=["n"], touched="sets")
    assert rows_of(after) == [("1", None, "y"), ("9", None, "m")]
    whole = tables.partial_update(current, changes.drop("sets"), order=["n"])
    assert rows_of(whole) == [("1", None, "z"), ("9", "n", "m")]
    cells = changes.select(F.col("id").alias("rowkey"), "n", "v", "w")
    stored = current.withColumnRenamed("id", "rowkey")
    assert rows_of(tables.put_cells(stored, cells, order=["n"])) == [("1", "x", "z"), ("9", "n", "m")]


def test_missing_ids_fail(spark):
    current = spark.createDataFrame([("1", "a")], "id string, v string")
    bad = spark.createDataFrame([(None, "x")], current.schema)
    for update in (lambda: tables.upsert_by_id(current, bad, ["v"]), lambda: tables.partial_update(current, bad)):
        with pytest.raises(Exception, match="a row has no id"):
            update().collect()


@pytest.mark.parametrize("kind, value", [("INT", "abc"), ("INT", 3_000_000_000), ("INT", "2.5"), ("DATE", "soon"), ("BOOL", "yes"), ("DOUBLE", "x"), ("BIGDECIMAL", "NaN")])
def test_a_filter_value_of_another_type_fails(kind, value):
    with pytest.raises(ValueError, match=kind):
        FilterSpec("v", ">", value, kind)


def test_patient_ids_with_the_separator_fail(spark):
    visits = spark.createDataFrame([("A|1", "02")], "IN_PATIENT_ID string, VISIT_TYPE_CODE string")
    with pytest.raises(Exception, match="separator in patient id"):
        lookups.routed_visits(visits, "o").collect()


def test_search_without_a_page_returns_all(spark):
    index = spark.range(50).select(F.col("id").cast("string").alias("id"))
    assert scans.search_index(index, []).count() == 50
    assert scans.search_index(index, [], start=45).count() == 5


def test_few_and_many_masters_take_one_path(spark):
    def docs(n):
        pid, code = F.lit("0001"), F.lit("02")
        masters = spark.range(n).select(
            F.concat(F.lit("1000|o|0001|02|"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("rowkey"),
            pid.alias("IN_PATIENT_ID"), pid.alias("OUT_PATIENT_ID"), code.alias("VISIT_TYPE_CODE"),
            *[F.lit(c).alias(c) for c in "EID VISIT_TYPE_NAME INP_NO OUTP_NO PERSON_NAME SEX_CODE SEX_NAME ID_CARD_NO HOME_PHONE DATE_OF_BIRTH".split()],
        )
        visits = spark.createDataFrame([("v", "0001", "1", "02")], "rowkey string, IN_PATIENT_ID string, VISIT_ID string, VISIT_TYPE_CODE string")
        assert lookups.route_by_type(visits, masters, "o").count() == n
        return [len(r["id"]) for r in lookups.multi_value_docs(visits, masters, "o", part_size=2000).orderBy("part").collect()]

    assert docs(5) == [5]
    assert docs(5000) == [2000, 2000, 1000]


def test_long_texts(spark):
    one = spark.range(1).select(
        F.lit("1岁" * 10_000 + "2月").alias("age"), F.lit(",".join(f"k{i % 3000}:v{i}" for i in range(4000))).alias("pairs")
    )
    assert one.select(dates.age_text_to_days("age")).first()[0] == 365 + 60
    started = time.perf_counter()
    found = one.select(text.split_map("pairs", ",", ":")).first()[0]
    assert time.perf_counter() - started < 5
    assert len(found) == 3000 and found["k5"] == "v3005" and found["k2999"] == "v2999"


def test_times_with_other_spellings(spark):
    one = spark.createDataFrame([("2024-01-05 10:00:00.0", "2024-1-5 1:00:00", "no time")], "a string, b string, c string")
    got = one.select(dates.minutes_between("b", "a"), dates.days_between("a", "b"), dates.minutes_between("a", "c")).first()
    assert tuple(got) == (540, 0, None)


def test_excluded_fields_at_every_level(spark):
    df = spark.range(1).select(
        F.struct(
            F.lit(1).alias("a"),
            F.lit(2).alias("handler"),
            F.struct(F.lit(3).alias("handler"), F.lit(None).cast("int").alias("b")).alias("inner"),
            F.array(F.struct(F.lit(4).alias("handler"), F.lit(5).alias("c"))).alias("list"),
            F.create_map(F.lit("handler"), F.lit(6), F.lit("d"), F.lit(7)).alias("map"),
        ).alias("r")
    )
    got = df.select(text.rows_to_json("r", df.schema["r"].dataType)).first()[0]
    assert got == '{"a":1,"inner":{"b":null},"list":[{"c":5}],"map":{"d":7}}'
