"""Scan and source queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chartdex.catalog.registry import query, table
from chartdex.catalog.sql_views import with_views
from chartdex.operators.filters import FilterSpec
from chartdex.plans import views
from chartdex.sources import scans


@query("scan_all", "select c_custkey, c_name, c_mktsegment from customer")
def _(spark, sf_dir):
    return scans.scan_all(table(spark, sf_dir, "customer"), "c_custkey", "c_name", " ", "c_mktsegment")


@query("scan_filtered", "select o_orderkey, o_custkey from orders where o_orderstatus = 'F' and o_totalprice >= 200000")
def _(spark, sf_dir):
    specs = [FilterSpec("o_orderstatus", "=", "F"), FilterSpec("o_totalprice", ">=", 200000, "DOUBLE")]
    return scans.scan_filtered(table(spark, sf_dir, "orders"), specs, "o_orderkey", "o_custkey")


@query(
    "scan_filter_list",
    "select o_orderkey, o_orderpriority from orders where o_orderpriority = '1-URGENT' or o_orderpriority = '2-HIGH'",
)
def _(spark, sf_dir):
    specs = [FilterSpec("o_orderpriority", "=", p) for p in ("1-URGENT", "2-HIGH")]
    return scans.scan_filter_list(table(spark, sf_dir, "orders"), specs, "any", "o_orderkey", "o_orderpriority")


@query(
    "scan_filter_list_keep_missing",
    """select p_partkey, p_name, nullif(p_type,'ECONOMY') as p_type from part
       where (p_type = 'PROMO' or p_type = 'ECONOMY') and p_size >= 10""",
)
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("p_type", F.nullif("p_type", F.lit("ECONOMY")))
    specs = [FilterSpec("p_type", "=", "PROMO"), FilterSpec("p_size", ">=", 10, "INT")]
    return scans.scan_filter_list(part, specs, "all", "p_partkey", "p_name", "p_type", missing="keep")


_INCREMENTAL = "select o_orderkey, o_custkey from orders where o_orderdate >= timestamp '{}-01-01 00:00:00'"


@query("scan_incremental", _INCREMENTAL.format(2000))
def _(spark, sf_dir):
    return scans.scan_incremental(
        table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey", "o_custkey", as_of=dt.date(2000, 5, 1)
    )


@query("scan_incremental_first_quarter", _INCREMENTAL.format(1999))
def _(spark, sf_dir):
    return scans.scan_incremental(
        table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey", "o_custkey", as_of=dt.date(2000, 2, 1)
    )


@query(
    "scan_incremental_text",
    with_views("adr_event", "select pk_event_id, patient_id, monitor_time from adr_event where monitor_time >= '2000'"),
)
def _(spark, sf_dir):
    events = views.adr_event(spark, sf_dir)
    return scans.scan_incremental(
        events, "monitor_time", "pk_event_id", "patient_id", "monitor_time", as_of=dt.date(2000, 5, 1)
    )


@query("scan_incremental_no_time_field", "select o_orderkey from orders")
def _(spark, sf_dir):
    return scans.scan_incremental(table(spark, sf_dir, "orders"), " ", "o_orderkey")


@query(
    "scan_prefix",
    with_views(
        "patients",
        """select rowkey, EID, PERSON_NAME, VISIT_TYPE_CODE from patients
           where rowkey >= '2' and rowkey < '2}' and VISIT_TYPE_CODE = '02'""",
    ),
)
def _(spark, sf_dir):
    return scans.scan_prefix_text(views.patients(spark, sf_dir), "2", "VISIT_TYPE_CODE|=|02;EID|=|", ";", "EID", "PERSON_NAME")


@query(
    "get_by_key",
    with_views("patients", "select * from patients where rowkey = '2100|1.2.156|00000012|02|1'"),
)
def _(spark, sf_dir):
    return scans.get_by_key(views.patients(spark, sf_dir), "2100|1.2.156|00000012|02|1")


@query(
    "get_by_keys",
    """select c_custkey, c_name, c_mktsegment from customer
       where c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT')""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    keys = orders.select(F.col("o_custkey").alias("c_custkey"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return scans.get_by_keys(customer, keys, "c_custkey")


_REGION_SQL = """select c_custkey, c_name, n_name, r_name from customer
                 join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""


@query(
    "sql_query",
    f"select cast(c_custkey as varchar) as c_custkey, n_name, r_name from ({_REGION_SQL}) q",
)
def _(spark, sf_dir):
    for name in ("customer", "nation", "region"):
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return scans.sql_query(spark, _REGION_SQL, ["c_custkey", "n_name", "r_name"])


@query(
    "select_table",
    """select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, o_orderstatus,
       cast(o_totalprice as varchar) as o_totalprice, cast(o_orderdate as varchar) as o_orderdate, o_orderpriority
       from orders where o_orderstatus <> 'P'""",
)
def _(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return scans.select_table(spark, "select * from orders where o_orderstatus <> 'P'", "orders")


@query(
    "search_index",
    with_views(
        "patients",
        """select rowkey as id, EID, PERSON_NAME, HOME_PHONE from patients
           where HOME_PHONE is not null and SEX_CODE = '1' order by PERSON_NAME desc, rowkey limit 50 offset 20""",
    ),
)
def _(spark, sf_dir):
    index = views.patients(spark, sf_dir).withColumnRenamed("rowkey", "id")
    replaced = [FilterSpec("SEX_CODE", "=", "2")]
    effective = [FilterSpec("HOME_PHONE", "notnull"), FilterSpec("SEX_CODE", "=", "1")]
    return scans.search_index(
        index, [replaced, effective], [F.col("PERSON_NAME").desc()],
        ["id", "EID", "PERSON_NAME", "HOME_PHONE"], start=20, rows=50,
    )


@query(
    "search_index_all",
    with_views(
        "patients",
        "select rowkey as id, EID, PERSON_NAME from patients where HOME_PHONE is not null and SEX_CODE = '1'",
    ),
)
def _(spark, sf_dir):
    index = views.patients(spark, sf_dir).withColumnRenamed("rowkey", "id")
    effective = [FilterSpec("HOME_PHONE", "notnull"), FilterSpec("SEX_CODE", "=", "1")]
    return scans.search_index(index, [effective], [F.col("PERSON_NAME").desc()], ["id", "EID", "PERSON_NAME"])


@query(
    "search_index_text",
    """select doc_id as id, source, n_chars from documents where contains(text, 'ing') or contains(text, 'tion')
       order by n_chars desc, doc_id limit 25""",
)
def _(spark, sf_dir):
    index = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id")
    return scans.search_index(
        index, [[FilterSpec("text", "inlike", "ing,tion")]], [F.col("n_chars").desc()], ["id", "source", "n_chars"], rows=25
    )
