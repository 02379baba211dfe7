"""Table maintenance and sink queries."""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chartdex.catalog.registry import query, table
from chartdex.catalog.sql_views import with_views
from chartdex.operators import tables
from chartdex.plans import views
from chartdex.session import shared_folder
from chartdex.sources import batch_sink, sinks

_SPLIT = "2000-01-01 00:00:00"
_BY_CUSTOMER = """select o_custkey as id, o_orderkey as last_order, o_orderpriority as priority, o_totalprice as price from (
  select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders where o_orderdate {0}) t where rn = 1"""
OLD_DOCS = _BY_CUSTOMER.format(f"< timestamp '{_SPLIT}'")
NEW_DOCS = _BY_CUSTOMER.format(f">= timestamp '{_SPLIT}'")


def order_docs(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("last_order"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("price"),
        "o_orderdate",
    )


def recent():
    return F.col("o_orderdate") >= F.lit(_SPLIT).cast("timestamp_ntz")


@query(
    "upsert_by_id",
    f"select * from ({NEW_DOCS}) n union all select * from ({OLD_DOCS}) o where id not in (select id from ({NEW_DOCS}) m)",
)
def _(spark, sf_dir):
    docs = order_docs(spark, sf_dir)
    order = ["o_orderdate", "last_order"]
    current = tables.latest_by_key(docs.where(~recent()), ["id"], order).drop("o_orderdate")
    return tables.upsert_by_id(current, docs.where(recent()), order)


@query(
    "partial_update",
    """with cur as (select c_custkey as id, c_name, c_mktsegment from customer where c_acctbal >= 0),
       chg as (select o_custkey as id, case when max(o_totalprice) > 400000 then null else 'URGENT' end as c_mktsegment,
               count(*) as urgent_orders from orders where o_orderpriority = '1-URGENT' group by o_custkey)
       select coalesce(cur.id, chg.id) as id, c_name,
       case when chg.id is not null then chg.c_mktsegment else cur.c_mktsegment end as c_mktsegment, urgent_orders
       from cur full join chg on cur.id = chg.id""",
)
def _(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    current = customer.select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment")
    urgent = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    changes = urgent.groupBy(F.col("o_custkey").alias("id")).agg(
        F.when(F.max("o_totalprice") <= 400000, "URGENT").alias("c_mktsegment"),
        F.count(F.lit(1)).alias("urgent_orders"),
    )
    return tables.partial_update(current, changes)


@query(
    "partial_update_latest",
    """with cur as (select c_custkey as id, c_name, c_mktsegment as state from customer),
       chg as (select o_custkey as id, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn,
               nullif(o_orderstatus, 'P') as state, o_orderkey from orders),
       tot as (select o_custkey as id, arg_max(o_totalprice, row(o_orderdate, o_orderkey)) as price from orders
               where o_orderpriority = '1-URGENT' group by o_custkey)
       select coalesce(cur.id, chg.id) as id, c_name, case when chg.id is not null then chg.state else cur.state end as state,
       tot.price from cur full join (select * from chg where rn = 1) chg on cur.id = chg.id left join tot on tot.id = chg.id""",
)
def _(spark, sf_dir):
    current = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name", F.col("c_mktsegment").alias("state"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    changes = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.nullif("o_orderstatus", F.lit("P")).alias("state"),
        F.col("o_totalprice").alias("price"),
        F.when(urgent, F.array(F.lit("state"), F.lit("price"))).otherwise(F.array(F.lit("state"))).alias("sets"),
        "o_orderdate",
        "o_orderkey",
    )
    return tables.partial_update(current, changes, order=["o_orderdate", "o_orderkey"], touched="sets")


@query(
    "put_nonblank_latest",
    """with chg as (select o_custkey as rowkey,
         arg_max(a, row(o_orderdate, o_orderkey)) filter (a <> '') as c_name,
         arg_max(b, row(o_orderdate, o_orderkey)) filter (trim(b) <> '') as c_mktsegment
         from (select *, case when o_orderstatus = 'F' then o_orderpriority else '' end as a,
                         case when o_totalprice > 200000 then ' ' else o_orderstatus end as b from orders) o group by o_custkey)
       select coalesce(c_custkey, chg.rowkey) as rowkey, coalesce(chg.c_name, c.c_name) as c_name,
       coalesce(chg.c_mktsegment, c.c_mktsegment) as c_mktsegment from customer c full join chg on c_custkey = chg.rowkey""",
)
def _(spark, sf_dir):
    changes = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("rowkey"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise("").alias("c_name"),
        F.when(F.col("o_totalprice") > 200000, " ").otherwise(F.col("o_orderstatus")).alias("c_mktsegment"),
        "o_orderdate",
        "o_orderkey",
    )
    current = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("rowkey"), "c_name", "c_mktsegment")
    return tables.put_nonblank(current, changes, order=["o_orderdate", "o_orderkey"])


@query(
    "delete_by_key",
    with_views(
        "patients",
        f"""select rowkey, EID, PERSON_NAME from patients where EID not in (
            select 'E'||lpad(cast(c_custkey as varchar),8,'0') from customer where c_mktsegment = 'BUILDING')""",
    ),
)
def _(spark, sf_dir):
    gone = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    keys = gone.select(F.concat(F.lit("E"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("EID"))
    index = views.patients(spark, sf_dir).select("rowkey", "EID", "PERSON_NAME")
    return tables.delete_by_key(index, keys)


@query("delete_all", with_views("patients", "select cast(0 as bigint) as remaining, count(*) as before from patients"))
def _(spark, sf_dir):
    index = views.patients(spark, sf_dir)
    stored = index.select(F.lit(0).alias("remaining"), F.lit(1).alias("before"))
    left = tables.delete_all(index).select(F.lit(1).alias("remaining"), F.lit(0).alias("before"))
    return stored.unionByName(left).agg(F.sum("remaining").alias("remaining"), F.sum("before").alias("before"))


_PUT_SQL = """with cur as (select c_custkey as rowkey, c_name, c_mktsegment, cast(c_nationkey as varchar) as c_nation from customer),
  chg as (select p_partkey as rowkey, {0} as c_name, {1} as c_mktsegment, p_brand from part)
  select coalesce(cur.rowkey, chg.rowkey) as rowkey, coalesce({2}, cur.c_name) as c_name,
  coalesce({3}, cur.c_mktsegment) as c_mktsegment, c_nation, p_brand from cur full join chg on cur.rowkey = chg.rowkey"""


def put_current(spark, sf_dir):
    nation = F.col("c_nationkey").cast("string").alias("c_nation")
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("rowkey"), "c_name", "c_mktsegment", nation)


@query(
    "put_cells",
    _PUT_SQL.format("case when p_size > 25 then p_name end", "nullif(p_type,'ECONOMY')", "chg.c_name", "chg.c_mktsegment"),
)
def _(spark, sf_dir):
    changes = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("rowkey"),
        F.when(F.col("p_size") > 25, F.col("p_name")).alias("c_name"),
        F.nullif("p_type", F.lit("ECONOMY")).alias("c_mktsegment"),
        "p_brand",
    )
    return tables.put_cells(put_current(spark, sf_dir), changes)


@query(
    "put_cells_latest",
    """with chg as (select l_suppkey as rowkey,
         arg_max(a, row(l_shipdate, l_orderkey, a)) filter (a is not null) as s_name,
         arg_max(b, row(l_shipdate, l_orderkey, b)) filter (b is not null) as flag
         from (select *, case when l_returnflag = 'R' then 'R'||cast(l_partkey as varchar) end as a,
                         case when l_linestatus = 'F' then l_returnflag end as b from lineitem) l group by l_suppkey)
       select coalesce(s_suppkey, chg.rowkey) as rowkey, coalesce(chg.s_name, s.s_name) as s_name, flag
       from supplier s full join chg on s_suppkey = chg.rowkey""",
)
def _(spark, sf_dir):
    puts = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("rowkey"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("R"), F.col("l_partkey").cast("string"))).alias("s_name"),
        F.when(F.col("l_linestatus") == "F", F.col("l_returnflag")).alias("flag"),
        "l_shipdate",
        "l_orderkey",
    )
    current = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("rowkey"), "s_name")
    return tables.put_cells(current, puts, order=["l_shipdate", "l_orderkey"])


def blank_changes(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("rowkey"),
        F.when(F.col("p_size") > 25, F.col("p_name")).otherwise("").alias("c_name"),
        F.when(F.col("p_type") == "ECONOMY", " ").otherwise(F.col("p_type")).alias("c_mktsegment"),
        "p_brand",
    )


BLANK_CHANGES_SQL = _PUT_SQL.format(
    "case when p_size > 25 then p_name else '' end",
    "case when p_type='ECONOMY' then ' ' else p_type end",
    "nullif(trim(chg.c_name),'')",
    "nullif(trim(chg.c_mktsegment),'')",
)


@query("put_nonblank", BLANK_CHANGES_SQL)
def _(spark, sf_dir):
    return tables.put_nonblank(put_current(spark, sf_dir), blank_changes(spark, sf_dir))


@query(
    "put_nonblank_written",
    """select p_partkey as rowkey, cast(1 + (p_size > 25)::int + (p_type <> 'ECONOMY')::int as bigint) as cells_written from part""",
)
def _(spark, sf_dir):
    return tables.nonblank_cells(blank_changes(spark, sf_dir)).select("rowkey", "cells_written")


_EVENT_FIELDS = ", ".join(tables.EVENT_COLUMNS)
_KEYED = f"""keyed as (select (select max(pk_event_id) from adr_event where monitor_time < '2000')
  + row_number() over (order by monitor_time, visit_id) as pk_event_id, {_EVENT_FIELDS} from adr_event where monitor_time >= '2000')"""


def _stored_and_new_events(spark, sf_dir):
    events = views.adr_event(spark, sf_dir)
    stored = events.where(F.col("monitor_time") < "2000")
    return stored, events.where(F.col("monitor_time") >= "2000").drop("pk_event_id")


@query(
    "append_events",
    with_views("adr_event", "select * from adr_event where monitor_time < '2000' union all select * from keyed", _KEYED),
)
def _(spark, sf_dir):
    stored, new = _stored_and_new_events(spark, sf_dir)
    return tables.append_events(stored, new, ["monitor_time", "visit_id"])


def _append_children_sql(view: str, columns: list[str]) -> str:
    rest = ", ".join(columns[1:])
    natural = f"cast({view}.pk_event_id - 1 as varchar)"
    return with_views(
        f"adr_event {view}",
        f"""select {view}.pk_event_id, {rest} from {view} join adr_event e on e.pk_event_id = {view}.pk_event_id where e.monitor_time < '2000'
            union all select keyed.pk_event_id, {rest} from {view} join keyed on keyed.visit_id = {natural}""",
        _KEYED,
    )


def _append_children(spark, sf_dir, view, append):
    stored, new = _stored_and_new_events(spark, sf_dir)
    keyed = tables.assign_event_keys(stored, new, ["monitor_time", "visit_id"])
    rows = view(spark, sf_dir)
    current = rows.join(stored.select("pk_event_id"), "pk_event_id", "left_semi")
    later = rows.join(stored.select("pk_event_id"), "pk_event_id", "left_anti")
    incoming = later.withColumn("visit_id", (F.col("pk_event_id") - 1).cast("string")).drop("pk_event_id")
    return append(current, tables.with_event_keys(incoming, keyed, ["visit_id"]))


@query("append_labinfo", _append_children_sql("adr_labinfo", tables.LABINFO_COLUMNS))
def _(spark, sf_dir):
    return _append_children(spark, sf_dir, views.adr_labinfo, tables.append_labinfo)


@query("append_drugs", _append_children_sql("adr_drug", tables.DRUG_COLUMNS))
def _(spark, sf_dir):
    return _append_children(spark, sf_dir, views.adr_drug, tables.append_drugs)


_CHILD_KEYS = """children as (select l.*, case when l.pk_event_id % 5 = 0 then 'none' when l.pk_event_id % 5 = 1 then null
       else cast(l.pk_event_id - 1 as varchar) end as natural_id from adr_labinfo l),
  named as (select pk_event_id, case when pk_event_id = 2 then null else visit_id end as natural_id from adr_event)"""


def _named_children(spark, sf_dir):
    """Lab rows that name their event by its visit: some name none, some the one without a visit."""
    n = F.col("pk_event_id")
    name = F.when(n % 5 == 0, "none").when(n % 5 != 1, (n - 1).cast("string"))
    children = views.adr_labinfo(spark, sf_dir).withColumn("natural_id", name).drop("pk_event_id")
    events = views.adr_event(spark, sf_dir).select("pk_event_id", F.when(n != 2, F.col("visit_id")).alias("natural_id"))
    return tables.with_event_keys(children, events, ["natural_id"])


@query(
    "append_children_null_key",
    with_views(
        "adr_event adr_labinfo",
        """select n.pk_event_id, c.order_no, c.order_item_code from children c join named n on c.natural_id is not distinct from n.natural_id""",
        _CHILD_KEYS,
    ),
)
def _(spark, sf_dir):
    keyed = _named_children(spark, sf_dir)
    stored = views.adr_labinfo(spark, sf_dir).limit(0)
    added = tables.append_labinfo(stored, keyed.where(F.col("pk_event_id").isNotNull()))
    return added.select("pk_event_id", "order_no", "order_item_code")


@query(
    "append_children_unmatched",
    with_views(
        "adr_event adr_labinfo",
        """select c.natural_id, c.order_no, c.order_item_code from children c
           where not exists (select 1 from named n where c.natural_id is not distinct from n.natural_id)""",
        _CHILD_KEYS,
    ),
)
def _(spark, sf_dir):
    return tables.without_event(_named_children(spark, sf_dir)).select("natural_id", "order_no", "order_item_code")


_ORDERED = """ordered as (select patient_id, visit_id, order_no, order_item_code, lab_result_value, monitor_time
  from adr_event e join adr_labinfo l on e.pk_event_id = l.pk_event_id)"""


@query(
    "append_idempotent",
    with_views(
        "adr_event adr_labinfo",
        """select patient_id, visit_id, order_no, order_item_code, lab_result_value from stored
           union all select patient_id, visit_id, order_no, order_item_code, lab_result_value from (
             select *, row_number() over (partition by patient_id, visit_id, order_no order by order_item_code, lab_result_value) as rn
             from ordered where monitor_time >= '1999') f where rn = 1 and not exists (
             select 1 from stored s where s.patient_id = f.patient_id and s.visit_id = f.visit_id and s.order_no = f.order_no)""",
        _ORDERED,
        "stored as (select * from ordered where monitor_time < '2000')",
    ),
)
def _(spark, sf_dir):
    rows = views.adr_event(spark, sf_dir).join(views.adr_labinfo(spark, sf_dir), "pk_event_id")
    fields = ["patient_id", "visit_id", "order_no", "order_item_code", "lab_result_value"]
    stored = rows.where(F.col("monitor_time") < "2000").select(*fields)
    incoming = rows.where(F.col("monitor_time") >= "1999").select(*fields)
    return tables.append_idempotent(stored, incoming, ["order_item_code", "lab_result_value"])


@query(
    "append_idempotent_null",
    """with o as (select case when o_orderkey % 3 = 0 then null else o_custkey end as patient_id, o_orderstatus as visit_id,
         nullif(o_orderpriority, '5-LOW') as order_no, o_orderkey from orders),
       stored as (select * from o where o_orderkey % 2 = 0)
       select * from stored union all select patient_id, visit_id, order_no, o_orderkey from (
         select *, row_number() over (partition by patient_id, visit_id, order_no order by o_orderkey) as rn from o) f
       where rn = 1 and not exists (select 1 from stored s where s.patient_id is not distinct from f.patient_id
         and s.visit_id is not distinct from f.visit_id and s.order_no is not distinct from f.order_no)""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("patient_id"),
        F.col("o_orderstatus").alias("visit_id"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("order_no"),
        "o_orderkey",
    )
    once = tables.append_idempotent(rows.where(F.col("o_orderkey") % 2 == 0), rows, ["o_orderkey"])
    return tables.append_idempotent(once, rows, ["o_orderkey"])


def _debtors():
    # a missing segment makes the condition null for some rows
    return (F.col("c_acctbal") < 0) & (F.nullif("c_mktsegment", F.lit("BUILDING")) != "MACHINERY")


_DEBTORS = "c_acctbal < 0 and nullif(c_mktsegment,'BUILDING') <> 'MACHINERY'"


@query(
    "update_where",
    f"""select c_custkey, c_name, case when {_DEBTORS} then 0.0 else c_acctbal end as c_acctbal,
        case when {_DEBTORS} then c_mktsegment||'*' else c_mktsegment end as c_mktsegment from customer""",
)
def _(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    values = {"c_acctbal": F.lit(0.0), "c_mktsegment": F.concat("c_mktsegment", F.lit("*"))}
    return tables.update_where(customer, _debtors(), values)


@query("update_where_affected", f"select count(*) filter ({_DEBTORS}) as affected from customer")
def _(spark, sf_dir):
    return tables.affected_rows(table(spark, sf_dir, "customer"), _debtors())


@query("delete_where", f"select c_custkey, c_name from customer where not coalesce({_DEBTORS}, false)")
def _(spark, sf_dir):
    return tables.delete_where(table(spark, sf_dir, "customer"), _debtors()).select("c_custkey", "c_name")


@query("write_batched", "select count(*) as docs, count(distinct o_orderkey) as ids, true as within_size, true as failed_once from orders")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    path = f"{shared_folder(spark)}/batches-{uuid.uuid4().hex}"
    # a task of the first attempt fails behind some batches, so nothing of it may be seen
    lost = F.raise_error(F.lit("lost")).cast("bigint")
    last = F.col("o_orderkey") % 1000 == 999
    failed = False
    try:
        batch_sink.save_batches(docs.withColumn("o_custkey", F.when(last, lost).otherwise(F.col("o_custkey"))), path, "run")
    except PySparkException:
        failed = True
    batch_sink.save_batches(docs, path, "run")
    batch_sink.save_batches(docs, path, "run")  # and once more, as a retried job would
    kept = batch_sink.read_batches(spark, path, docs.schema, "o_orderkey")
    folders = [f"{path}/{r['folder']}" for r in batch_sink.committed(spark, path).collect()]
    per_file = spark.read.parquet(*folders).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    largest = per_file.agg((F.max("n") <= batch_sink.BATCH_SIZE).alias("within_size"))
    counted = kept.agg(F.count(F.lit(1)).alias("docs"), F.countDistinct("o_orderkey").alias("ids"))
    return counted.select("docs", "ids", largest.scalar().alias("within_size"), F.lit(failed).alias("failed_once"))


@query(
    "number_batches",
    """select batch_no, count(*) as docs, min(o_orderkey) as first_key, max(o_orderkey) as last_key from (
       select o_orderkey, (row_number() over (order by o_orderkey) - 1) // 1000 as batch_no from orders) t group by batch_no""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    batches = sinks.number_batches(docs, ["o_orderkey"])
    return batches.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("docs"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )
