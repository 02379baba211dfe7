"""Date, time and age queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chartdex.catalog.registry import query, table
from chartdex.catalog.sql_views import with_views
from chartdex.functions import dates
from chartdex.plans import views

_NOON = "2024-01-15 12:00:00"
# event times as text, one event type with text that is no time
_EVENTS = "(select event_id, event_type, ts, case event_type when 'error' then 'bad' else strftime(ts,'%Y-%m-%d %H:%M:%S') end as txt from events) e"
_APART = f"cast(epoch(timestamp '{_NOON}') - epoch(try_strptime(txt,'%Y-%m-%d %H:%M:%S')) as bigint)"


def _events(spark, sf_dir):
    txt = F.when(F.col("event_type") == "error", "bad").otherwise(F.date_format("ts", dates.TIMESTAMP_FORMAT))
    return table(spark, sf_dir, "events").withColumn("txt", txt)


def _between(name: str, expression, sql: str) -> None:
    @query(name, f"select event_id, {sql} as n from {_EVENTS}")
    def _(spark, sf_dir):
        return _events(spark, sf_dir).select("event_id", expression(F.col("txt"), F.lit(_NOON)).alias("n"))


_between("minutes_between", dates.minutes_between, f"{_APART} // 60")
_between("minute_between", dates.minute_between, f"{_APART} // 60")
_between("minute_between_legacy", lambda s, e: dates.minute_between(s, e, legacy=True), f"{_APART} // 3600")
_between("hours_between", dates.hours_between, f"{_APART} // 3600")


@query(
    "days_between",
    """select l_orderkey, l_partkey, l_suppkey, case when l_returnflag = 'A' then null
       else date_diff('day', o_orderdate, l_shipdate) end as n from lineitem join orders on l_orderkey = o_orderkey""",
)
def _(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    shipped = F.col("l_shipdate").cast("string")
    end = F.when(F.col("l_returnflag") == "A", F.substring(shipped, 1, 4)).otherwise(shipped)
    n = dates.days_between(F.col("o_orderdate").cast("string"), end)
    return joined.select("l_orderkey", "l_partkey", "l_suppkey", n.alias("n"))


_YEARS_SQL = """select rowkey, cast(epoch(timestamp '2024-06-15 10:30:00') - epoch(strptime(DATE_OF_BIRTH||' 00:00:00','%Y-%m-%d %H:%M:%S')) as bigint) {0} as n from patients"""


def _years(name: str, legacy: bool, sql: str) -> None:
    @query(name, with_views("patients", _YEARS_SQL.format(sql)))
    def _(spark, sf_dir):
        born = F.concat("DATE_OF_BIRTH", F.lit(" 00:00:00"))
        n = dates.years_between(born, F.lit("2024-06-15 10:30:00"), legacy)
        return views.patients(spark, sf_dir).select("rowkey", n.alias("n"))


_years("years_between", False, "// 31536000")
_years("years_between_legacy", True, "* 1000 // 1471228928")


@query("year_month", "select o_orderkey, strftime(o_orderdate,'%Y-%m') as month, '2024-03' as run_month from orders")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.year_month("o_orderdate").alias("month"),
        dates.year_month(dt.date(2024, 3, 9)).alias("run_month"),
    )


def _age_sql(year: int, month_day: str) -> str:
    return f"""{year} - cast(substr(DATE_OF_BIRTH,1,4) as bigint)
        - case when substr(DATE_OF_BIRTH,6) > '{month_day}' then 1 else 0 end"""


@query(
    "age_band",
    with_views(
        "patients",
        f"""select rowkey, case when SEX_CODE = '2' and HOME_PHONE is null then null when age <= 6 then '0_6' when age <= 17 then '7_17'
            when age <= 28 then '18_28' when age <= 40 then '29_40' when age <= 65 then '41_65' else '66_' end as band
            from (select *, {_age_sql(2015, "06-15")} as age from patients) a""",
    ),
)
def _(spark, sf_dir):
    odd = (F.col("SEX_CODE") == "2") & F.col("HOME_PHONE").isNull()
    birthday = F.when(odd, "bad").otherwise(F.concat("DATE_OF_BIRTH", F.lit(" 08:00")))
    return views.patients(spark, sf_dir).select("rowkey", dates.age_band(birthday, F.lit("2015-06-15")).alias("band"))


@query("age_years", with_views("patients", f"select rowkey, cast({_age_sql(1990, '06-15')} as bigint) as age from patients"))
def _(spark, sf_dir):
    age = dates.age_years(F.col("DATE_OF_BIRTH"), dt.date(1990, 6, 15))
    return views.patients(spark, sf_dir).select("rowkey", age.alias("age"))


@query(
    "format_ts",
    f"""select event_id, strftime(ts,'%Y-%m-%d %I:%M:%S') as twelve_hour,
        strftime(try_strptime(txt,'%Y-%m-%d %H:%M:%S'),'%Y/%m/%d %H') as of_text from {_EVENTS}""",
)
def _(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id",
        dates.format_ts("ts", "yyyy-MM-dd hh:mm:ss").alias("twelve_hour"),
        dates.format_ts_text("txt", "yyyy/MM/dd HH").alias("of_text"),
    )


@query(
    "parse_ts",
    f"""select event_id, strftime(try_strptime(txt,'%Y-%m-%d %H:%M:%S'),'%Y%m%d%H%M%S') as parsed,
        strftime(coalesce(try_strptime(txt,'%Y-%m-%d %H:%M:%S'), timestamp '{_NOON}'),'%Y%m%d%H%M%S') as defaulted from {_EVENTS}""",
)
def _(spark, sf_dir):
    compact = "yyyyMMddHHmmss"
    return _events(spark, sf_dir).select(
        "event_id",
        F.date_format(dates.parse_ts("txt"), compact).alias("parsed"),
        F.date_format(dates.parse_ts("txt", default=_NOON), compact).alias("defaulted"),
    )


_UNIT = "case event_id % 7 when 0 then 'Y' when 1 then 'M' when 2 then 'D' when 3 then 'H' when 4 then 'm' when 5 then 'S' else 'x' end"
_STEP = "case unit when 'Y' then to_years(n) when 'M' then to_months(n) when 'D' then to_days(n) when 'H' then to_hours(n) when 'm' then to_minutes(n) when 'S' then to_seconds(n) else to_days(0) end"


@query(
    "shift_ts",
    f"""select event_id, strftime(ts + {_STEP},'%Y-%m-%d %H:%M:%S') as later, strftime(ts - {_STEP},'%Y-%m-%d %H:%M:%S') as earlier,
        strftime(ts + to_months(1),'%Y-%m-%d %H:%M:%S') as next_month
        from (select event_id, ts, cast(user_id as int) as n, {_UNIT} as unit from events) e""",
)
def _(spark, sf_dir):
    unit = F.get(F.array(*[F.lit(u) for u in [*dates.SHIFT_UNITS, "x"]]), (F.col("event_id") % 7).cast("int"))
    diff = F.concat(F.col("user_id").cast("string"), unit)
    rows = table(spark, sf_dir, "events").select("event_id", "ts", diff.alias("diff"))
    shifted = {
        "later": dates.shift_ts("ts", F.col("diff"), "add"),
        "earlier": dates.shift_ts("ts", F.col("diff")),
        "next_month": dates.shift_ts("ts", "1M", "add"),
    }
    return rows.select("event_id", *[dates.plain_text(c).alias(n) for n, c in shifted.items()])


# whole milliseconds, cut off rather than rounded, as times in stored text have no finer unit
_MS = f"(epoch_us(timestamp '{_NOON}') // 1000 - epoch_us(ts) // 1000) // 1000"


@query(
    "diff_ts",
    f"""select event_id, {_MS} // 86400 as days, {_MS} // 3600 as hours, {_MS} // 60 as minutes, {_MS} as seconds,
        cast(0 as bigint) as other from events""",
)
def _(spark, sf_dir):
    units = {"days": "D", "hours": "H", "minutes": "m", "seconds": "S", "other": "x"}
    noon = F.lit(_NOON).cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", *[dates.diff_ts("ts", noon, u).alias(n) for n, u in units.items()])


@query(
    "shift_today",
    """select event_id, strftime(date '2024-03-01' - cast(user_id as int), '%Y-%m-%d') as back_then,
       strftime(date '2024-03-01' + cast(user_id as int), '%Y-%m-%d') as ahead from events""",
)
def _(spark, sf_dir):
    days, as_of = F.col("user_id").cast("int"), dt.date(2024, 3, 1)
    return table(spark, sf_dir, "events").select(
        "event_id",
        dates.shift_today("pre", days, as_of).alias("back_then"),
        dates.shift_today("back", days, as_of).alias("ahead"),
    )


_AGE_TEXT = """(select p_partkey, p_size, case p_type when 'ECONOMY' then p_size||'岁'||(p_size%12)||'月'||(p_size%28)||'天'
  when 'LARGE' then (p_size/2.0)||'年 '||p_size||'日' when 'MEDIUM' then p_size||'月'||p_size||'小时' when 'PROMO' then '约'||p_size||'岁'
  when 'SMALL' then cast(p_size as varchar) else ' ' end as txt from part) t"""


def _age_texts(spark, sf_dir):
    size, kind = F.col("p_size"), F.col("p_type")
    txt = (
        F.when(kind == "ECONOMY", F.concat(size, F.lit("岁"), size % 12, F.lit("月"), size % 28, F.lit("天")))
        .when(kind == "LARGE", F.concat((size / 2.0).cast("string"), F.lit("年 "), size, F.lit("日")))
        .when(kind == "MEDIUM", F.concat(size, F.lit("月"), size, F.lit("小时")))
        .when(kind == "PROMO", F.concat(F.lit("约"), size, F.lit("岁")))
        .when(kind == "SMALL", size.cast("string"))
        .otherwise(" ")
    )
    return table(spark, sf_dir, "part").select("p_partkey", txt.alias("txt"))


@query(
    "age_text_to_days",
    f"""select p_partkey, txt, cast(case when txt = ' ' then -1 when contains(txt,'约') then 0 when contains(txt,'岁')
        then p_size*365 + (p_size%12)*30 + p_size%28 when contains(txt,'年') then p_size/2.0*365 + p_size
        when contains(txt,'月') then p_size*30 else 0 end as double) as days from {_AGE_TEXT}""",
)
def _(spark, sf_dir):
    return _age_texts(spark, sf_dir).withColumn("days", dates.age_text_to_days("txt"))


@query(
    "age_text_to_years",
    f"""select p_partkey, txt, cast(case when txt = ' ' or contains(txt,'约') or contains(txt,'年') then -1 when contains(txt,'岁')
        then p_size when contains(txt,'月') then 1 else p_size end as double) as years from {_AGE_TEXT}""",
)
def _(spark, sf_dir):
    return _age_texts(spark, sf_dir).withColumn("years", dates.age_text_to_years("txt"))



@query(
    "times_mixed",
    """select o_orderkey, strftime(o_orderdate, '%Y%m%d%H%M%S') as parsed, 95 as minutes, 1 as hours, 95 as minute, 0 as years,
       date_diff('day', o_orderdate::date, (o_orderdate + interval 95 minute)::date) as days from orders""",
)
def _(spark, sf_dir):
    n, start = F.col("o_orderkey") % 3, F.col("o_orderdate")
    end = start + F.expr("interval 95 minutes")

    def text(t):
        plain = F.date_format(t, dates.TIMESTAMP_FORMAT)
        return F.when(n == 0, plain).when(n == 1, F.concat(plain, F.lit(".0"))).otherwise(F.date_format(t, "yyyy-M-d H:m:s"))

    a, b = text(start), text(end)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.format_ts_text(a, "yyyyMMddHHmmss").alias("parsed"),
        dates.minutes_between(a, b).alias("minutes"),
        dates.hours_between(a, b).alias("hours"),
        dates.minute_between(a, b).alias("minute"),
        dates.years_between(a, b).alias("years"),
        dates.days_between(a, b).alias("days"),
    )
