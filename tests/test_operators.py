"""Filters, reshaping, ordering, scans and table maintenance on small literal tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartdex.functions import codes
from chartdex.operators import filters, lookups, ordering, reshape, tables
from chartdex.operators.filters import FilterSpec
from chartdex.operators.numbering import SortKey, number_rows, number_within
from chartdex.sources import scans


def values(df, column):
    return sorted(r[column] for r in df.collect())


@pytest.fixture
def cells(spark):
    return spark.createDataFrame([(1, "10"), (2, "95"), (3, None), (4, "a,b")], "id int, v string")


@pytest.mark.parametrize(
    "spec, expected",
    [
        (FilterSpec("v", ">", "9"), [2, 4]), (FilterSpec("v", ">", "9", "INT"), [1, 2]), (FilterSpec("v", "<>", "10"), [2, 4]),
        (FilterSpec("v", "nlike", "0"), [2, 4]), (FilterSpec("v", "nin", "10,x"), [2, 4]), (FilterSpec("v", "in", "10,95,"), [1, 2]),
        (FilterSpec("v", "inlike", "0,b"), [1, 4]), (FilterSpec("v", "sw", "1,9"), [1, 2]), (FilterSpec("v", "ew", "5,b"), [2, 4]),
        (FilterSpec("v", "like", "^1|5$", regex=True), [1, 2]), (FilterSpec("v", "like", "^1"), []), (FilterSpec("v", "in", "1.,x", regex=True), [1]),
        (FilterSpec("v", "sw", "[0-8]", regex=True), [1]), (FilterSpec("v", "ew", "[0-8],b", regex=True), [1, 2, 4]),
        (FilterSpec("v", "inlike", "9.,z", regex=True), [2]), (FilterSpec("v", "nin", "1.", regex=True), [2, 4]),
        (FilterSpec("v", "isnull"), [3]), (FilterSpec("v", "notnull"), [1, 2, 4]), (FilterSpec("v", "=", "95", "LONG"), [2]),
        (FilterSpec("v", ">=", "10.5", "BIGDECIMAL"), [2]), (FilterSpec("v", "=", "x", "ENUM"), []),
    ],
)
def test_filters(cells, spec, expected):
    assert values(filters.filter_rows(cells, spec), "id") == expected


def test_typed_filters_leave_typed_cells_uncast(spark):
    rows = spark.createDataFrame([(2**40, dt.datetime(2024, 1, 2), True), (5, dt.datetime(2024, 1, 1), False)], "n bigint, t timestamp, b boolean")
    assert values(filters.filter_rows(rows, FilterSpec("n", ">", "7", "INT")), "n") == [2**40]
    assert values(filters.filter_rows(rows, FilterSpec("t", "<", "2024-01-02 00:00:00", "DATE")), "n") == [5]
    assert values(filters.filter_rows(rows, FilterSpec("b", "=", "true", "BOOL")), "n") == [2**40]
    assert values(filters.filter_rows(rows, FilterSpec("n", ">", "7")), "n") == []


def test_filter_errors():
    with pytest.raises(ValueError):
        FilterSpec("v", "~", "1")
    with pytest.raises(ValueError):
        FilterSpec("v", "=", "1", "BLOB")
    with pytest.raises(ValueError):
        filters.combine([], "some")


def test_filters_from_text(cells):
    specs = filters.specs_from_text("a|in|1,2;b|=|;c|sw|x;d|=|  ", ";")
    assert [(s.name, s.op, s.value) for s in specs] == [("a", "in", "1,2"), ("c", "sw", "x")]
    assert filters.specs_from_text("  ", ";") == filters.specs_from_text(None, ";") == []
    assert filters.filter_rows(cells).count() == 4


def test_filter_lists(cells):
    specs = [FilterSpec("v", "=", "10"), FilterSpec("v", "=", "95")]
    assert values(scans.scan_filter_list(cells, specs, "any"), "id") == [1, 2]
    assert values(scans.scan_filter_list(cells, specs, "all"), "id") == []
    assert values(scans.scan_filter_list(cells, specs, "any", missing="keep"), "id") == [1, 2, 3]


def test_incremental_start():
    assert scans.incremental_start(dt.date(2000, 3, 31)) == 1999
    assert scans.incremental_start(dt.date(2000, 4, 1)) == 2000


def test_incremental_drops_missing_times(spark):
    rows = spark.createDataFrame([(1, "1999-12-31"), (2, "2000"), (3, None)], "id int, t string")
    assert values(scans.scan_incremental(rows, "t", as_of=dt.date(2000, 5, 1)), "id") == [2]
    assert values(scans.scan_incremental(rows, None, as_of=dt.date(2000, 5, 1)), "id") == [1, 2, 3]


def test_projection_keeps_the_row_key(spark):
    rows = spark.createDataFrame([("k", "1", "2")], "rowkey string, a string, b string")
    assert scans.scan_all(rows, "a", "", None).columns == ["rowkey", "a"]
    assert scans.scan_all(rows).columns == ["rowkey", "a", "b"]
    assert scans.scan_filtered(rows, [FilterSpec("b", "=", "2")], "a").columns == ["rowkey", "a"]
    assert scans.scan_prefix(rows, "k", [FilterSpec("b", "=", "2")], "a").columns == ["rowkey", "a", "b"]


def test_search_pages(spark):
    index = spark.createDataFrame([(i, i % 3) for i in range(10)], "id int, g int")
    pages = [[r["id"] for r in scans.search_index(index, [], [F.col("g").asc()], start=s, rows=4).collect()] for s in (0, 4, 8)]
    assert pages == [[0, 3, 6, 9], [1, 4, 7, 2], [5, 8]]
    last = scans.search_index(index, [[FilterSpec("g", "=", "1")], [FilterSpec("g", "=", "2")]])
    assert values(last, "id") == [2, 5, 8]


def test_key_value_pairs(spark):
    rows = spark.createDataFrame([("a", "b", 2), ("", "b", 1), ("a", None, 1), ("a", " ", 1), ("a", "c", 1)], "k string, v string, n int")
    assert sorted(map(tuple, reshape.to_kv(rows, "k", "v").collect())) == [("a", "b"), ("a", "c")]
    assert [tuple(r) for r in reshape.to_kv_dedup(rows, "k", "v").collect()] == [("a", "b")]
    assert [tuple(r) for r in reshape.to_kv_dedup(rows, "k", "v", "n").collect()] == [("a", "c")]
    assert reshape.to_kv(rows, "k", "absent").count() == 0


def test_keyed_and_renamed_records(spark):
    rows = spark.createDataFrame([("r1", None, "O1", "x"), ("r2", "", None, None)], "rowkey string, IN_PATIENT_ID string, OUT_PATIENT_ID string, a string")
    keyed = {r["key"]: r["record"] for r in reshape.to_keyed_map(rows, "a", "zz", "a").collect()}
    assert keyed == {"r1": {"rowkey": "r1", "a": "x", "zz": None}, "r2": {"rowkey": "r2", "a": None, "zz": None}}
    renamed = [tuple(r) for r in reshape.to_renamed_map(rows, {"b": "a"}).orderBy("rowkey").collect()]
    assert renamed == [("O1", "r1", "x"), (None, "r2", None)]


def test_fields_to_map(spark):
    rows = spark.createDataFrame([("x", " ", None)], "a string, b string, c string")
    mappings = {"one": "a", "two": "b", "three": "c", "four": "absent", " ": "a"}
    record = lambda **k: rows.select(reshape.fields_to_map(rows, mappings, **k).alias("m")).first()["m"]
    assert record() == {"one": "x", "two": " "}
    assert record(blanks=False) == {"one": "x"}
    assert rows.select(F.size(reshape.fields_to_map(rows, {})).alias("n")).first()["n"] == 0


def test_numbering_is_dense_over_a_frequent_key(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).alias("k"), "id").repartition(16)
    numbered = number_rows(rows, [SortKey(F.col("k"), ascending=False), "id"]).orderBy("row_no").collect()
    assert [r["row_no"] for r in numbered] == list(range(1, 5001))
    assert [(-r["k"], r["id"]) for r in numbered] == sorted((-r["k"], r["id"]) for r in numbered)
    within = number_within(rows, ["k"], ["id"]).collect()
    by_key = {}
    for r in sorted(within, key=lambda r: r["id"]):
        by_key.setdefault(r["k"], []).append(r["row_no"])
    assert all(numbers == list(range(1, len(numbers) + 1)) for numbers in by_key.values())


def test_numbering_of_no_rows(spark):
    assert number_rows(spark.range(0), [F.col("id")]).count() == 0
    assert number_within(spark.range(0).withColumn("k", F.lit(1)), ["k"], ["id"]).count() == 0


@pytest.mark.parametrize("partitions", [1, 2, 13])
def test_numbering_with_nulls_in_any_order(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    rows = [(None if i % 7 == 0 else i % 5, "x" * (i % 3) if i % 4 else None, i) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b string, id int").repartition(4)
    order = [SortKey(F.col("a"), False), SortKey(F.col("b"), True, nulls_first=False), "id"]
    got = {r["id"]: r["row_no"] for r in number_rows(df, order, start=10).collect()}
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1] is None, r[1] or "", r[2])
    assert [got[r[2]] for r in sorted(rows, key=key)] == list(range(10, 310))
    within = {r["id"]: r["n"] for r in number_within(df, ["a"], [SortKey(F.col("b"), False), "id"], "n").collect()}
    for a in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == a), key=lambda r: (r[1] is None, -len(r[1] or ""), r[2]))
        assert [within[r[2]] for r in group] == list(range(1, len(group) + 1))
    spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_numbering_starts_no_job_and_stores_nothing(spark):
    rows = spark.range(1000).withColumn("k", F.col("id") % 3)
    context = spark.sparkContext
    context.setJobGroup("numbering", "built only")
    numbered = [number_rows(rows, ["k", "id"]), number_within(rows, ["k"], ["id"])]
    assert not context.statusTracker().getJobIdsForGroup("numbering")
    context.setJobGroup("other", "other")
    for df in numbered:
        assert "ExistingRDD" not in df._jdf.queryExecution().executedPlan().toString()


def test_sort_order(spark):
    rows = spark.createDataFrame([(1, "b", "2020-01-01"), (2, None, " "), (3, "a", "1899-01-01"), (4, "  ", None)], "id int, s string, d string")
    ids = lambda df: [r["id"] for r in df.collect()]
    assert ids(ordering.sort_multi(rows, ["s", "id"], ["asc", "desc"])) == [2, 4, 3, 1]
    assert ids(ordering.sort_desc_by_date(rows, "d"))[::3] == [1, 3]
    assert ids(ordering.sort_by(rows, "s"))[2:] == [3, 1]
    assert ids(ordering.sort_by(rows, "s", "down"))[:2] == [1, 3]
    with pytest.raises(ValueError):
        ordering.multi_order(["a", "b"], ["asc"])


def test_put_cells(spark):
    current = spark.createDataFrame([("r", "1", "2")], "rowkey string, a string, b string")
    changes = spark.createDataFrame([("r", "9", None, "3"), ("n", None, "5", None)], "rowkey string, a string, b string, c string")
    after = {r["rowkey"]: tuple(r)[1:] for r in tables.put_cells(current, changes).collect()}
    assert after == {"r": ("9", "2", "3"), "n": (None, "5", None)}


def test_put_nonblank(spark):
    current = spark.createDataFrame([("r", "1", "2")], "rowkey string, a string, b string")
    changes = spark.createDataFrame([("r", "", "5")], "rowkey string, a string, b string")
    assert [tuple(r) for r in tables.put_nonblank(current, changes).collect()] == [("r", "1", "5")]
    assert tables.nonblank_cells(changes).first()["cells_written"] == 1


def test_collapse_cells(spark):
    puts = spark.createDataFrame([("r", 1, "a", "x"), ("r", 3, None, "z"), ("r", 2, "b", None)], "rowkey string, n int, a string, b string")
    assert tuple(tables.collapse_cells(puts, "rowkey", ["n"]).first()) == ("r", "b", "z")


def test_upsert(spark):
    current = spark.createDataFrame([("1", "old", 0), ("2", "kept", 0)], "id string, v string, n int")
    incoming = spark.createDataFrame([("1", "early", 1), ("1", "late", 2), ("3", "new", 1)], "id string, v string, n int")
    after = sorted(tuple(r) for r in tables.upsert_by_id(current, incoming, ["n"]).collect())
    assert after == [("1", "late", 2), ("2", "kept", 0), ("3", "new", 1)]


def test_partial_update(spark):
    current = spark.createDataFrame([("1", "a", "b"), ("2", "c", "d")], "id string, v string, w string")
    changes = spark.createDataFrame([("1", None, "n"), ("9", "z", "m")], "id string, v string, x string")
    after = sorted((tuple(r) for r in tables.partial_update(current, changes).collect()))
    assert after == [("1", None, "b", "n"), ("2", "c", "d", None), ("9", "z", None, "m")]


def test_append_events_keeps_nulls_and_starts_at_one(spark):
    schema = "pk_event_id bigint, " + ", ".join(f"{c} string" for c in tables.EVENT_COLUMNS)
    empty = spark.createDataFrame([], schema)
    new = spark.createDataFrame([tuple([None, "p", str(i)] + ["x"] * 9) for i in (2, 1)], schema.split(", ", 1)[1])
    rows = tables.append_events(empty, new, ["patient_id", "visit_id"]).orderBy("pk_event_id").collect()
    assert [(r["pk_event_id"], r["event_name"], r["visit_id"]) for r in rows] == [(1, None, "1"), (2, None, "2")]


def test_append_idempotent_twice_changes_nothing(spark):
    schema = "patient_id string, visit_id string, order_no string, v string"
    current = spark.createDataFrame([("p", "1", "N1", "stored")], schema)
    incoming = spark.createDataFrame([("p", "1", "N1", "again"), ("p", "1", "N2", "b"), ("p", "1", "N2", "a")], schema)
    once = tables.append_idempotent(current, incoming, ["v"])
    assert sorted(r["v"] for r in once.collect()) == ["a", "stored"]
    assert tables.append_idempotent(once, incoming, ["v"]).count() == 2


def test_update_and_delete_where_ignore_null_conditions(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, v string")
    hit = F.col("v") == "a"
    assert sorted((r["id"], r["v"]) for r in tables.update_where(rows, hit, {"v": F.lit("z")}).collect()) == [(1, "z"), (2, None), (3, "b")]
    assert values(tables.delete_where(rows, hit), "id") == [2, 3]
    assert tables.affected_rows(rows, hit).first()["affected"] == 1
    assert tables.delete_all(rows).count() == 0


def test_visit_type_plan(spark):
    visits = spark.createDataFrame([("01",), ("02",), (None,)], "VISIT_TYPE_CODE string")
    plan = lambda *a: sorted(str(r["VISIT_TYPE"]) for r in codes.visit_type_plan(visits, *a).collect())
    assert plan("VISIT_TYPE", True) == ["INPV", "OTHER", "OUTPV"]
    assert plan("INPV") == ["INPV"] * 3
    assert plan("INPV", True) == ["INPV"]
    assert plan("PHY", True) == ["None"] * 3


def master(spark, rows):
    columns = "rowkey,EID,IN_PATIENT_ID,OUT_PATIENT_ID,VISIT_TYPE_CODE,VISIT_TYPE_NAME"
    rest = "INP_NO,OUTP_NO,PERSON_NAME,SEX_CODE,SEX_NAME,ID_CARD_NO,HOME_PHONE,DATE_OF_BIRTH".split(",")
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.split(",")))
    return df.select("*", *[F.lit(c.lower()).alias(c) for c in rest])


def visit_list(spark, rows):
    df = spark.createDataFrame(rows, "rowkey string, IN_PATIENT_ID string, VISIT_ID string, VISIT_TYPE_CODE string")
    return df.select("*", F.lit("o").alias("OID"), F.lit("g").alias("GLOBLE_ID"), F.lit("visit-eid").alias("EID"))


def test_index_job_edges(spark):
    from chartdex.plans.index_job import patient_list_index, refresh_index

    patients = master(spark, [
        ("1000|o|0001|02|1", "E1", "0001", "O1", "02", "INPV"),
        ("1000|o|0001|02|2", "E0", "0001", "O1", "02", "INPV"),
        ("1000|o|0001|01|1", "E1", "0001", None, "01", "OUTPV"),
        ("2000|o|0002|01|1", "E2", "0002", "O2", "01", "OUTPV"),
        ("2000|o|0002|}", "E2", "0002", "O9", "01", "OUTPV"),
    ])
    visits = visit_list(spark, [
        ("v1", "0001", "9", "02"), ("v2", "0001", "10", "02"), ("v3", "0001", "1", "01"),
        ("v4", "0002", "x", "01"), ("v9", "0002", "-9223372036854775808", "01"), ("v5", "0002", "3", "01"), ("v6", "0002", "9", "03"), ("v7", "0002", "9", None), ("v8", "0404", "1", "02"),
    ])
    docs = {r["id"]: r for r in patient_list_index(visits, patients, "o").collect()}
    assert set(docs) == {"0001|02", "O2|01"}  # no outpatient number, no document
    assert (docs["0001|02"]["VISIT_ID"], docs["0001|02"]["EID"]) == ("10", "E0")
    assert docs["0001|02"]["VISIT_TYPE_NAME"] == "INPV" and docs["O2|01"]["VISIT_TYPE_NAME"] is None
    assert docs["O2|01"]["VISIT_ID"] == "3" and docs["O2|01"]["OUT_NO"] == "outp_no"

    one = patient_list_index(visits, patients, "o", patient_id="0002")
    assert values(one, "id") == ["O2|01"]
    index = patient_list_index(visits, patients, "o")
    assert refresh_index(index, one).count() == 2


def test_multi_value_documents_in_parts(spark):
    patients = master(spark, [(f"1000|o|0001|02|{i:02d}", f"E{i}", "0001", "O1", "02", "INPV") for i in range(7)])
    visits = visit_list(spark, [("v1", "0001", "9", "02"), ("v2", "0001", "10", "02")])
    docs = lookups.multi_value_docs(visits, patients, "o", part_size=3).orderBy("visit_rowkey", "part").collect()
    assert [(r["visit_rowkey"], r["part"], r["EID"]) for r in docs if r["visit_rowkey"] == "v1"] == [
        ("v1", 0, ["E0", "E1", "E2"]), ("v1", 1, ["E3", "E4", "E5"]), ("v1", 2, ["E6"]),
    ]
    assert docs[-1]["VISIT_ID"] == ["10"] and docs[0]["id"] == ["0001|02"] * 3
    whole = lookups.multi_value_docs(visits, patients, "o", part_size=10).collect()
    assert len(whole) == 2 and all(len(r["EID"]) == 7 for r in whole)


def test_doctors_first_record_or_none(spark):
    visits = visit_list(spark, [("v1", "0001", "9", "02"), ("v2", "0001", "8", "02")])
    records = spark.createDataFrame(
        [("1000|o|0001|b", "9", "D2"), ("1000|o|0001|a", "9", None), ("1000|o|0001|c", "7", "D7")], "rowkey string, VISIT_ID string, REQUEST_DOCTOR string"
    ).select("*", *[F.lit(c).alias(c) for c in lookups.DOCTOR_FIELDS[1:]])
    found = {r["rowkey"]: (r["REQUEST_DOCTOR"], r["DEPT"]) for r in lookups.lookup_doctors(visits, records, "o").collect()}
    assert found == {"v1": (None, "DEPT"), "v2": (None, None)}
    assert lookups.lookup_doctors(visits, records, "o").count() == 2


def test_exists_count(spark):
    events = spark.createDataFrame([(1, "p", "v"), (2, "p", "v")], "pk_event_id bigint, patient_id string, visit_id string")
    labs = spark.createDataFrame([(1, "N1"), (1, "N1"), (2, "N1"), (2, "N2")], "pk_event_id bigint, order_no string")
    asked = spark.createDataFrame([("p", "v", "N1"), ("p", "v", "N1"), ("p", "v", "N9")], "patient_id string, visit_id string, order_no string")
    counts = {r["order_no"]: r["cnt"] for r in lookups.exists_count(asked, events, labs).collect()}
    assert counts == {"N1": 3, "N9": 0}


@pytest.mark.parametrize("partitions", [64, 211])
def test_numbering_plan_does_not_grow_with_a_power_of_the_partitions(spark, partitions):
    name = F.when(F.col("id") % 3 == 0, " ").otherwise(F.concat(F.lit("n"), (F.col("id") % 100).cast("string")))
    rows = spark.range(2000).select("id", name.alias("name")).repartition(4)
    order = [SortKey(F.when(F.trim("name") == "", "").otherwise(F.col("name")), False), "id"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for numbered in (number_rows(rows, order, "n"), number_within(rows, ["name"], ["id"], "n")):
            assert len(numbered._jdf.queryExecution().optimizedPlan().toString()) < 100_000
        got = {r["id"]: r["n"] for r in number_rows(rows, order, "n").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    text = lambda i: "" if i % 3 == 0 else f"n{i % 100}"
    # a stable sort, also in reverse: equal texts stay by id
    assert [got[i] for i in sorted(range(2000), key=text, reverse=True)] == list(range(1, 2001))
