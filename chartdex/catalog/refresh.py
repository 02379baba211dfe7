"""Queries over the stored index: changes by bucket, incremental refresh of the index job."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from chartdex.catalog.lookups import INDEX_SQL, index_sql
from chartdex.catalog.registry import query, table
from chartdex.catalog.tables import BLANK_CHANGES_SQL, NEW_DOCS, OLD_DOCS, blank_changes, order_docs, put_current, recent
from chartdex.operators import tables
from chartdex.plans import index_job, index_refresh, views
from chartdex.session import shared_folder
from chartdex.sources.bucket_index import BucketIndex

BUCKETS = 16


def _stored(spark, df, key):
    return BucketIndex.create(f"{shared_folder(spark)}/index-{uuid.uuid4().hex}", df, key, BUCKETS)


@query(
    "bucket_upsert",
    f"select * from ({NEW_DOCS}) n union all select * from ({OLD_DOCS}) o where id not in (select id from ({NEW_DOCS}) m)",
)
def _(spark, sf_dir):
    docs, order = order_docs(spark, sf_dir), ["o_orderdate", "last_order"]
    index = _stored(spark, tables.latest_by_key(docs.where(~recent()), ["id"], order).drop("o_orderdate"), "id")
    index.apply(lambda current, changes: tables.upsert_by_id(current, changes, order), docs.where(recent()))
    return index.read()


@query("bucket_put_nonblank", BLANK_CHANGES_SQL)
def _(spark, sf_dir):
    current = put_current(spark, sf_dir).withColumn("p_brand", F.lit(None).cast("string"))
    index = _stored(spark, current, "rowkey")
    index.apply(tables.put_nonblank, blank_changes(spark, sf_dir))
    return index.read()


@query(
    "bucket_partial_update",
    """with chg as (select o_custkey as id, count(*) as n from orders where o_orderpriority = '1-URGENT' group by o_custkey)
       select coalesce(c_custkey, chg.id) as id, c_name, case when chg.id is not null then 'URGENT' else c_mktsegment end as c_mktsegment
       from customer full join chg on c_custkey = chg.id""",
)
def _(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment")
    urgent = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    index = _stored(spark, customer, "id")
    index.apply(tables.partial_update, urgent.select(F.col("o_custkey").alias("id"), F.lit("URGENT").alias("c_mktsegment")).distinct())
    return index.read()


@query("bucket_delete", "select c_custkey, c_name from customer where c_mktsegment <> 'BUILDING' or c_mktsegment is null")
def _(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    index = _stored(spark, customer.select("c_custkey", "c_name"), "c_custkey")
    gone = customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    index.apply(lambda current, keys: tables.delete_by_key(current, keys, "c_custkey"), gone)
    return index.read()


@query("index_refresh_touched", INDEX_SQL)
def _(spark, sf_dir):
    """Visits come, masters come and change; the stored index follows."""
    visits, patients = views.visits(spark, sf_dir), views.patients(spark, sf_dir)
    number, patient = F.col("VISIT_ID").cast("bigint"), F.col("IN_PATIENT_ID").cast("bigint")
    known = number % 10 != 3
    # some masters were not there yet, others had another name and another outpatient number
    absent, other = patient % 13 == 0, patient % 11 == 0
    before = patients.where(~absent).select(
        *[c for c in patients.columns if c not in ("PERSON_NAME", "OUT_PATIENT_ID")],
        F.when(other, "former name").otherwise(F.col("PERSON_NAME")).alias("PERSON_NAME"),
        F.when(other, F.concat(F.lit("X"), "OUT_PATIENT_ID")).otherwise(F.col("OUT_PATIENT_ID")).alias("OUT_PATIENT_ID"),
    )
    index = _stored(spark, index_job.patient_list_index(visits.where(known), before, views.OID), "id")
    changed = patients.where(absent | other).unionByName(before.where(other))
    index_refresh.refresh_bucket_index(index, visits, patients, visits.where(~known), changed, views.OID)
    return index.read()


@query("index_refresh_deleted", index_sql("cast(VISIT_ID as bigint) % 3 <> 0", "cast(IN_PATIENT_ID as bigint) % 17 <> 0"))
def _(spark, sf_dir):
    """Visits and masters go; documents without a source leave the stored index."""
    visits, patients = views.visits(spark, sf_dir), views.patients(spark, sf_dir)
    index = _stored(spark, index_job.patient_list_index(visits, patients, views.OID), "id")
    kept, stays = F.col("VISIT_ID").cast("bigint") % 3 != 0, F.col("IN_PATIENT_ID").cast("bigint") % 17 != 0
    index_refresh.refresh_bucket_index(
        index, visits.where(kept), patients.where(stays), visits.where(~kept), patients.where(~stays), views.OID
    )
    return index.read()
