"""Literal edge cases of the column expressions."""

import datetime as dt

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chartdex.catalog import load
from chartdex.functions import blank, codes, dates, keys, text
from chartdex.operators import ordering, reshape
from chartdex.operators.lookups import enum_label, province_by_id
from tests.compare import problem

SPACE = "　"


def col(value):
    return F.lit(value).cast("string") if value is None or isinstance(value, str) else F.lit(value)


@pytest.fixture
def value(spark):
    def evaluate(column):
        return spark.range(1).select(column.alias("v")).first()["v"]

    return evaluate


@pytest.mark.parametrize("v, expected", [(None, True), ("", True), (" ", True), ("\t", True), (SPACE, True), ("a", False), (" ", False), (" \n ", True)])
def test_blank(value, v, expected):
    assert value(blank.is_blank(col(v))) is expected


@pytest.mark.parametrize(
    "v, start, end, expected",
    [
        ("12345678", -4, 0, "8765"), ("123", -4, 0, "zzzz"), ("12345678", 0, 4, "4321"), ("123", 0, 4, "zzzz"),
        ("123456", -4, -1, "543"), ("1234", 2, 1, "zzzz"), ("1234", -1, -2, "zzzz"), (None, -4, 0, None), ("1234", 0, 0, ""),
    ],
)
def test_salt(value, v, start, end, expected):
    assert value(keys.salt(col(v), start, end)) == expected


def test_row_keys(value):
    assert value(keys.rowkey_prefix(col("00000012"), "1.2.156")) == "2100|1.2.156|00000012"
    parts = [col("p"), col("INPV"), col("3"), col("E00000012")]
    assert value(keys.visit_rowkey(*parts, "9")) == "2100|9|E00000012|INPV|3|p"
    for i in range(4):
        blanked = [col(" ") if j == i else p for j, p in enumerate(parts)]
        assert value(keys.visit_rowkey(*blanked, "9")) is None
    assert value(keys.visit_rowkey_prefix(col("E12"), "9")) is None
    assert value(keys.prefix_of(col("a|b|c|d|e"))) == "a|b|c"


def test_prefix_range(spark):
    rows = spark.createDataFrame([(k,) for k in ("P|", "P|a", "P|}", "P|~", "Q")], "rowkey string")
    assert [r[0] for r in rows.where(keys.in_prefix_range("rowkey", "P|")).collect()] == ["P|", "P|a"]


@pytest.mark.parametrize(
    "key, expected",
    [("s|o|p|", True), ("s|o|p|1", True), ("s|o|p||", True), ("s|o|p|}", False), ("s|o|p|~", False), ("s|o|p|中", False), ("s|o|p", False), ("s|o\n|p|\n", True)],
)
def test_own_prefix_range(value, key, expected):
    assert value(keys.in_own_prefix_range(col(key))) is expected


@pytest.mark.parametrize(
    "a, b, op, expected",
    [(1.0, 2.0, "<", True), (1.0, 1.0, "≥", True), (1.0, 2.0, "≠", True), (1.0, 2.0, "?", False), (1.0, 2.0, None, False), (2.0, 1.0, "≤", False)],
)
def test_compare_values(value, a, b, op, expected):
    assert value(text.compare_values(F.lit(a), F.lit(b), col(op))) is expected


@pytest.mark.parametrize(
    "v, expected",
    [
        ("1e3", True), (" 12 ", True), ("NaN", True), ("abc", False), ("", False), (None, False), ("1d", True),
        ("0x1p3", True), ("-Infinity", True), ("inf", False), ("nan", False), ("+NaN", True), ("INFINITY", False),
    ],
)
def test_is_number(value, v, expected):
    assert value(text.is_number(col(v))) is expected


def test_first_nonempty_and_identifier_kinds(value):
    assert value(blank.first_nonempty(col(None), col(""), col("  "), col("x"))) == "  "
    assert codes.identifier_fields("HOSPTIAL_NO") == ["INP_NO", "OUTP_NO"]
    assert codes.identifier_fields("PASSPORT") is None


@pytest.mark.parametrize(
    "old, v, replace, update, expected",
    [
        (None, "x", "-", False, "x"), (None, " ", "-", False, "-"), (None, " ", None, False, None), ("-", "x", "-", False, "x"),
        ("-", "", "-", False, "-"), ("a", "x", "-", False, "a"), ("a", "x", "-", True, "x"), ("a", None, "-", True, "-"),
        ("a", "", None, True, "a"), ("a", "x", None, False, "a"), ("a", "x", None, True, "x"), (None, "x", None, False, "x"),
    ],
)
def test_fill_replace(value, old, v, replace, update, expected):
    assert value(blank.fill_replace(col(old), col(v), replace, update)) == expected


def test_obj_to_str(value):
    assert value(blank.obj_to_str(col(None))) == ""
    assert value(blank.obj_to_str(col(None), "d")) == "d"
    assert value(blank.obj_to_str(col("d"), "d", "r")) == "r"
    assert value(blank.obj_to_str(col("x"), "d", "r")) == "x"
    assert value(blank.obj_to_str(F.lit(5))) == "5"


def test_visit_codes(value):
    assert [value(codes.visit_type_by_code(col(c))) for c in ("01", "02", "03", "09", "77", None)] == [
        "OUTPV", "INPV", "PHY", "OTHER", "OTHER", "OTHER",
    ]
    assert [value(codes.visit_code_by_type(col(c))) for c in ("OUTPV", "INPV", "PHY", "OTHER", "zz", None)] == [
        "01", "02", "03", "09", None, None,
    ]


def test_labels(spark):
    cards = spark.createDataFrame([("1101",), ("65x",), ("7100",), (None,)], "c string")
    assert {r["c"]: r["province"] for r in province_by_id(cards, "c").collect()} == {"1101": "北京", "65x": "新疆", "7100": None, None: None}
    labelled = enum_label(cards, F.substring("c", 1, 2), [("11", "first"), ("65", "x"), ("11", "last")])
    assert {r["c"]: r["label"] for r in labelled.collect()} == {"1101": "last", "65x": "x", "7100": "", None: ""}


def test_minutes_and_hours(value):
    day = "2024-01-01 "
    assert value(dates.minutes_between(col(day + "00:01:30"), col(day + "00:00:00"))) == -1
    assert value(dates.minutes_between(col("bad"), col(day + "00:00:00"))) is None
    assert value(dates.minute_between(col(day + "00:00:00"), col(day + "02:30:00"))) == 150
    assert value(dates.minute_between(col(day + "00:00:00"), col(day + "02:30:00"), legacy=True)) == 2
    assert value(dates.hours_between(col(day + "05:30:00"), col(day + "00:00:00"))) == -5
    assert value(dates.hours_between(col(""), col(day + "00:00:00"))) is None


def test_days_and_years(value):
    assert value(dates.days_between(col("2016-04-13 00:00:00"), col("2016-04-13 01:03:01"))) == 0
    assert value(dates.days_between(col("2016-04-13 23:00:00"), col("2016-04-12 01:03:01"))) == -1
    assert value(dates.days_between(col("2016"), col("2016-04-13"))) is None
    assert value(dates.days_between(col("2016-04-13"), col("no date at all"))) is None
    span = [col("2015-01-01 00:00:00"), col("2017-01-01 00:00:00")]
    assert value(dates.years_between(*span)) == 2
    assert value(dates.years_between(*span, legacy=True)) == 42
    assert dates.LEGACY_YEAR_MS == 1471228928
    assert value(dates.years_between(col(" "), span[1])) is None


@pytest.mark.parametrize(
    "birthday, target, expected",
    [
        ("2000-02-29", "2007-02-28", "0_6"), ("2000-02-29", "2007-03-01", "7_17"), ("2020-01-01", "2007-03-01", "0_6"), ("bad", "2007-03-01", None),
        ("1990-01-02 10:00:00", "2018-12-31", "18_28"), ("1990-1-2", "2019-01-02", "29_40"), ("1942-01-02", "2008-01-02", "66_"), (None, "2000-01-01", None),
    ],
)
def test_age_band(value, birthday, target, expected):
    assert value(dates.age_band(col(birthday), col(target))) == expected


def test_age_years(value):
    assert value(dates.age_years(F.lit(dt.date(2000, 2, 29)), dt.date(2001, 2, 28))) == 0
    assert value(dates.age_years(F.lit(dt.date(2001, 3, 1)), dt.date(2001, 2, 28))) == -1


@pytest.mark.parametrize(
    "start, diff, direction, expected",
    [
        ("2024-01-31 10:00:00", "1M", "add", "2024-02-29 10:00:00"), ("2024-02-29 10:00:00", "1Y", "add", "2025-02-28 10:00:00"),
        ("2024-01-31 10:00:00", "3D", "sub", "2024-01-28 10:00:00"), ("2024-01-31 10:00:00", "5x", "add", "2024-01-31 10:00:00"),
        ("2024-01-31 10:00:00", "90m", "whatever", "2024-01-31 08:30:00"), ("2024-01-31 10:00:00", "5S", "add", "2024-01-31 10:00:05"),
        ("2024-01-31 23:00:00", "2H", "add", "2024-02-01 01:00:00"),
    ],
)
def test_shift_ts(value, start, diff, direction, expected):
    moved = dates.shift_ts(F.lit(start).cast("timestamp"), diff, direction)
    assert value(F.date_format(moved, dates.TIMESTAMP_FORMAT)) == expected


@pytest.mark.parametrize(
    "start, diff, expected",
    [
        ("2024-02-29 23:00:01", "1024Y", "1000-02-28 23:00:01"),
        ("2024-02-29 23:00:01", "2023Y", "0001-02-28 23:00:01"),
        ("2024-02-29 23:00:01", "2024Y", "0000-02-29 23:00:01"),
        ("2024-02-29 23:00:01", "2025Y", "-1-02-28 23:00:01"),
        ("2024-02-29 23:00:01", "3000Y", "-976-02-29 23:00:01"),
        ("2024-02-29 23:00:01", "9000Y", "-6976-02-29 23:00:01"),
        ("2024-02-29 23:00:01", "-7975Y", "9999-02-28 23:00:01"),
        ("2024-02-29 23:00:01", "-7976Y", "10000-02-29 23:00:01"),
        ("2024-02-29 23:00:01", "-89999Y", "92023-02-28 23:00:01"),
    ],
)
def test_years_of_any_length_as_text(value, start, diff, expected):
    assert value(dates.plain_text(dates.shift_ts(F.lit(start).cast("timestamp"), diff))) == expected


def test_shift_ts_agrees_with_its_sql_on_far_years(spark, tmp_path):
    steps = [0, 1, 999, 2023, 2024, 2025, 2900, 9000, 89999]
    at, path = dt.datetime(2024, 1, 30, 12, 0, 5, 250000), tmp_path / "events.parquet"
    # every step meets every unit
    rows = {"event_id": range(63), "ts": [at] * 63, "user_id": [n for n in steps for _ in range(7)]}
    pd.DataFrame(rows).astype({"ts": "datetime64[us]"}).to_parquet(path)
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{path}'")
    queries, oracles = load()
    assert problem(spark, con, str(tmp_path), queries["shift_ts"], oracles["shift_ts"]) is None


def test_diff_format_parse_shift_today(value):
    begin, end = (F.lit(t).cast("timestamp") for t in ("2024-01-01 00:00:00", "2024-01-02 01:00:00"))
    assert [value(dates.diff_ts(begin, end, u)) for u in "DHmSx"] == [1, 25, 1500, 90000, 0]
    assert value(dates.diff_ts(end, begin, "D")) == -1
    assert value(dates.format_ts(F.lit("2024-01-01 13:01:30").cast("timestamp"), "hh")) == "01"
    assert value(dates.format_ts_text(col("2024-01-01 13:01:30"), "HH:mm")) == "13:01"
    assert value(dates.parse_ts(col("2016-13-45 00:00:00"))) is None
    assert value(dates.parse_ts(col("2016-13-45"), default="2020-01-01 00:00:00")) == dt.datetime(2020, 1, 1)
    assert value(dates.shift_today("pre", 30, dt.date(2024, 3, 1))) == "2024-01-31"
    assert value(dates.shift_today("back", 30, dt.date(2024, 3, 1))) == "2024-03-31"
    assert value(dates.date_compare(begin, begin)) is True
    assert value(dates.year_month(dt.date(2024, 3, 1))) == "2024-03"


@pytest.mark.parametrize(
    "v, expected",
    [
        ("3岁2月10天", 1165.0), ("1.5岁", 547.5), ("2年", 730.0), ("10日", 10.0), ("约3岁", 0.0), ("6个月", 0.0), ("1岁2岁", 730.0), ("", -1.0),
        (None, -1.0), ("1 岁 1 月", 395.0), ("岁", None), ("5小时", 0.0), ("3月5小时", 90.0), ("1.2.3岁", None),
    ],
)
def test_age_text_to_days(value, v, expected):
    assert value(dates.age_text_to_days(col(v))) == expected


@pytest.mark.parametrize(
    "v, expected", [("3岁2月", 3.0), ("5月", 1.0), ("7", 7.0), ("x岁", -1.0), ("abc", -1.0), (None, -1.0), ("岁", -1.0), ("5小时", 1.0), ("1.5岁", 1.5)]
)
def test_age_text_to_years(value, v, expected):
    assert value(dates.age_text_to_years(col(v))) == expected


@pytest.mark.parametrize("v, expected", [("a,,b, ,a", ["a", "b", "a"]), (" ", [" "]), ("", []), (None, None), ("a", ["a"]), (",", [])])
def test_split_list(value, v, expected):
    assert value(text.split_list(col(v), ",")) == expected


def test_split_list_takes_the_separator_literally(value):
    assert value(text.split_list(col("a|b|c"), "|")) == ["a", "b", "c"]
    assert value(text.split_list(col("a.*b"), ".*")) == ["a", "b"]
    assert value(text.split_list_distinct(col("a,,b, ,a"), ",")) == ["a", "b"]


def test_split_map(value):
    assert value(text.split_map(col("k1:v1,k2:v2:w,k3,k1:z,k4:"), ",", ":")) == {"k1": "z", "k2": "v2", "k4": ""}
    assert value(text.split_map(col("k:v"), ",", ":")) == {"k": "v"}
    assert value(text.split_map(col(""), ",", ":")) == {}


def test_joining_lists(value):
    items = F.array(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))
    assert value(text.list_to_string(items, ",")) == "a,,b"
    assert value(text.arr_to_string(items, ",")) == "a,null,b"
    assert value(text.list_distinct(F.array(*[F.lit(x) for x in "baba"]))) == ["b", "a"]


@pytest.mark.parametrize("v, expected", [("Ã©", "é"), ("", ""), (" ", " "), ("中", "?"), (None, None), ("éx", "�x"), ("😀a", "?a")])
def test_fix_mojibake(value, v, expected):
    assert value(text.fix_mojibake(col(v))) == expected


def test_json(spark, value):
    rows = spark.createDataFrame([('[{"k":1},{"k":2}]',), ("bad",), (None,)], "j string")
    exploded = rows.select(F.explode(text.json_to_rows("j", "k int")).alias("r")).select("r.k")
    assert [r["k"] for r in exploded.collect()] == [1, 2]
    record = F.struct(F.lit(None).cast("int").alias("a"), F.lit(1).alias("b"))
    assert value(text.rows_to_json(record)) == '{"a":null,"b":1}'
    assert value(text.rows_to_json(F.lit(None).cast("struct<a:int>"))) == "{}"
    assert value(text.rows_to_json(F.array(record))) == '[{"a":null,"b":1}]'
    stamped = F.struct(F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("t"))
    assert value(text.rows_to_json(stamped)) == '{"t":"2024-01-01 10:00:00"}'


def test_xml(value):
    node = value(text.map_to_xml(F.create_map(F.lit("k"), F.lit("1"), F.lit("n"), F.lit(None).cast("string"))))
    assert "".join(node.split("\n    ")).replace("\n", "") == '<node><key label="k">1</key><key label="n">null</key></node>'
    xml = text.json_to_xml(col('{"k":1,"b":"x"}'), "k int, b string")
    assert value(F.from_xml(xml, "k int, b string")).asDict() == {"k": 1, "b": "x"}
    assert value(text.json_to_xml(col("bad"), "k int")) is None


@pytest.mark.parametrize(
    "text_in, xml",
    [
        ('{"k":1,"b":"x<&"}', "<o><b>x&lt;&amp;</b><k>1</k></o>"),
        ('{"a":{"b":[1,{"c":null}],"z z":[],"1e":{}},"t":true}', '<o><a><_1e></_1e><b>1</b><b><c null="true"/></b><z_z></z_z></a><t>true</t></o>'),
        ("[1,[2,3],null]", '<o><item>1</item><item><item>2</item><item>3</item></item><item null="true"/></o>'),
        ('{"a":[[1,2],[3]]}', "<o><a><item>1</item><item>2</item></a><a><item>3</item></a></o>"),
        ("7", "<o>7</o>"),
        ("null", '<o null="true"/>'),
        ("{}", "<o></o>"),
        ("bad", None),
        (None, None),
    ],
)
def test_json_of_any_shape_to_xml(value, text_in, xml):
    assert value(text.json_to_xml(F.lit(text_in).cast("string"))) == xml


def test_json_nested_too_deeply_for_xml(value):
    nested = F.lit('{"a":{"b":{"c":1}}}')
    assert value(text.json_to_xml(nested, depth=3)) == "<o><a><b><c>1</c></b></a></o>"
    with pytest.raises(Exception, match="too deeply"):
        value(text.json_to_xml(nested, depth=2))


def test_maps(value):
    entries = F.create_map(F.lit("a"), F.lit(""), F.lit("b"), F.lit(None).cast("string"), F.lit("c"), F.lit("x"))
    assert value(reshape.put_to_map(entries)) == {"c": "x"}
    assert value(reshape.put_field_to_map(entries)) == {"a": "", "c": "x"}


def test_sort_directions(value):
    numbers = F.array(*[F.lit(n) for n in (2, 10, 1)])
    assert value(ordering.sort_ints(numbers, "asc")) == [1, 2, 10]
    assert value(ordering.sort_ints(numbers, " ")) == [1, 2, 10]
    assert value(ordering.sort_ints(numbers, "ASC")) == [10, 2, 1]
