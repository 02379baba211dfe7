"""Lookup, enrichment and index job queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chartdex.catalog.registry import query, table
from chartdex.catalog.sql_views import PREFIX_OF_PATIENT, PREFIX_OF_ROWKEY, VIEWS, with_views
from chartdex.functions import codes, keys
from chartdex.operators import aggregates, lookups
from chartdex.plans import index_job, views

_JOIN = f"from visits v join patients p on {PREFIX_OF_ROWKEY.format('p')} = {PREFIX_OF_PATIENT.format('v')}"


def _documents(code: str, inpatient: bool, all_fields: bool = True) -> str:
    number = "IN_PATIENT_ID" if inpatient else "OUT_PATIENT_ID"
    kinds = ["VISIT_TYPE_CODE", "VISIT_TYPE_NAME"] if all_fields else []
    typed = [f"p.{k}" if inpatient else f"cast(null as varchar) as {k}" for k in kinds]
    fields = ["EID", "IN_PATIENT_ID", "OUT_PATIENT_ID", "INP_NO", "PERSON_NAME", "SEX_CODE", "SEX_NAME"]
    fields += ["ID_CARD_NO", "HOME_PHONE", "DATE_OF_BIRTH"]
    columns = ", ".join([f"p.{f}" for f in fields] + typed)
    return f"""select v.rowkey as visit_rowkey, p.rowkey as master_rowkey, p.{number}||'|'||p.VISIT_TYPE_CODE as id,
      v.VISIT_ID, p.OUTP_NO as OUT_NO, {columns} {_JOIN} where v.VISIT_TYPE_CODE='{code}' and p.VISIT_TYPE_CODE='{code}'"""


_ALL_DOCUMENTS = f"{_documents('02', True)} union all by name {_documents('01', False)}"


def _tables(spark, sf_dir):
    return views.visits(spark, sf_dir), views.patients(spark, sf_dir)


@query("lookup_inpatient", with_views("patients visits", _documents("02", True)))
def _(spark, sf_dir):
    return lookups.lookup_inpatient(*_tables(spark, sf_dir), views.OID)


@query("lookup_outpatient", with_views("patients visits", _documents("01", False, all_fields=False)))
def _(spark, sf_dir):
    return lookups.lookup_outpatient(*_tables(spark, sf_dir), views.OID)


@query("route_by_type", with_views("patients visits", _ALL_DOCUMENTS))
def _(spark, sf_dir):
    return lookups.route_by_type(*_tables(spark, sf_dir), views.OID)


_LISTED = ["id", "EID", "IN_PATIENT_ID", "OUT_PATIENT_ID", "VISIT_ID", "OUT_NO", "PERSON_NAME", "DATE_OF_BIRTH"]


@query(
    "multi_value_doc",
    with_views(
        "patients visits",
        f"""select visit_rowkey, cast(0 as bigint) as part, cast(count(*) as bigint) as n_values,
            arg_min(id, master_rowkey) as first_id,
            {", ".join(f"string_agg({f}, ';' order by master_rowkey) as {f}" for f in _LISTED)}
            from ({_ALL_DOCUMENTS}) d group by visit_rowkey""",
    ),
)
def _(spark, sf_dir):
    docs = lookups.multi_value_docs(*_tables(spark, sf_dir), views.OID, part_size=1000)
    first = F.element_at("id", 1).alias("first_id")
    listed = [F.array_join(f, ";").alias(f) for f in _LISTED]
    return docs.select("visit_rowkey", "part", F.size("id").cast("bigint").alias("n_values"), first, *listed)


@query(
    "drop_no_id",
    with_views(
        "patients visits",
        f"""select visit_rowkey, id from ({_ALL_DOCUMENTS}) d
            where HOME_PHONE is not null or VISIT_TYPE_CODE is not null""",
    ),
)
def _(spark, sf_dir):
    visits, patients = _tables(spark, sf_dir)
    # masters without a phone lose their outpatient number, and with it their outpatient document
    unnumbered = F.when(F.col("HOME_PHONE").isNotNull(), F.col("OUT_PATIENT_ID"))
    found = lookups.route_by_type(visits, patients.withColumn("OUT_PATIENT_ID", unnumbered), views.OID)
    return found.select("visit_rowkey", "id")


@query(
    "lookup_doctors",
    with_views(
        "visits visit_records",
        f"""select v.*, f.REQUEST_DOCTOR, f.PARENT_DOCTOR, f.SUPER_DOCTOR, f.TMP_HOUSEMAN, f.DEPT from visits v left join (
            select * from (select r.*, {PREFIX_OF_ROWKEY.format("r")} as prefix,
              row_number() over (partition by {PREFIX_OF_ROWKEY.format("r")}, VISIT_ID order by rowkey) as rn from visit_records r) x
            where rn = 1) f on f.prefix = {PREFIX_OF_PATIENT.format("v")} and f.VISIT_ID = v.VISIT_ID""",
    ),
)
def _(spark, sf_dir):
    return lookups.lookup_doctors(views.visits(spark, sf_dir), views.visit_records(spark, sf_dir), views.OID)


def index_sql(visits: str = "true", patients: str = "true") -> str:
    """The index of the visits and masters that meet a condition each."""
    return with_views(
        "",
        f"""select id, EID, IN_PATIENT_ID, OUT_PATIENT_ID, VISIT_ID, INP_NO, OUT_NO, PERSON_NAME, SEX_CODE, SEX_NAME,
            ID_CARD_NO, HOME_PHONE, VISIT_TYPE_CODE, VISIT_TYPE_NAME, DATE_OF_BIRTH from (
            select d.*, row_number() over (partition by id order by cast(VISIT_ID as bigint) desc, EID, master_rowkey) as rn
            from ({_ALL_DOCUMENTS}) d) r where rn = 1""",
        f"patients as (select * from ({VIEWS['patients']}) p where {patients})",
        f"visits as (select * from ({VIEWS['visits']}) v where {visits})",
    )


INDEX_SQL = index_sql()


@query("patient_list_index", INDEX_SQL)
def _(spark, sf_dir):
    return index_job.patient_list_index(*_tables(spark, sf_dir), views.OID)


@query("patient_list_index_salt", INDEX_SQL)
def _(spark, sf_dir):
    # masters whose keys are salted by the first three characters of the id
    visits, patients = _tables(spark, sf_dir)
    patient = F.split_part("rowkey", F.lit("|"), F.lit(3))
    tail = F.substr("rowkey", F.instr("rowkey", "|"))
    salted = patients.withColumn("rowkey", F.concat(keys.salt(patient, 0, 3), tail))
    return index_job.patient_list_index(visits, salted, views.OID, salt_range=(0, 3))


@query(
    "event_lab_join",
    with_views(
        "adr_event adr_labinfo",
        """select e.pk_event_id, e.patient_id, e.visit_id, l.order_no, l.order_item_code, l.lab_result_value
           from adr_event e join adr_labinfo l on e.pk_event_id = l.pk_event_id""",
    ),
)
def _(spark, sf_dir):
    joined = lookups.event_lab_join(views.adr_event(spark, sf_dir), views.adr_labinfo(spark, sf_dir))
    return joined.select("pk_event_id", "patient_id", "visit_id", "order_no", "order_item_code", "lab_result_value")


@query(
    "exists_count",
    with_views(
        "adr_event adr_labinfo",
        """select k.patient_id, k.visit_id, k.order_no, count(l.pk_event_id) as cnt
           from (select pk_event_id, patient_id, visit_id, 'N1' as order_no from adr_event) k
           left join adr_labinfo l on l.pk_event_id = k.pk_event_id and l.order_no = k.order_no
           group by k.patient_id, k.visit_id, k.order_no""",
    ),
)
def _(spark, sf_dir):
    events = views.adr_event(spark, sf_dir)
    keys = events.select("patient_id", "visit_id", F.lit("N1").alias("order_no"))
    return lookups.exists_count(keys, events, views.adr_labinfo(spark, sf_dir))


_TYPE = "case VISIT_TYPE_CODE when '01' then 'OUTPV' when '02' then 'INPV' when '03' then 'PHY' else 'OTHER' end"


@query("visit_type_by_code", with_views("visits", f"select rowkey, {_TYPE} as visit_type from visits"))
def _(spark, sf_dir):
    return views.visits(spark, sf_dir).select("rowkey", codes.visit_type_by_code("VISIT_TYPE_CODE").alias("visit_type"))


@query(
    "visit_code_by_type",
    """select o_orderkey, case o_orderstatus when 'F' then '01' when 'O' then '02' when 'P' then null end as code,
       case o_orderpriority when '1-URGENT' then '03' when '5-LOW' then '09' end as other_code from orders""",
)
def _(spark, sf_dir):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    kind = F.when(status == "F", "OUTPV").when(status == "O", "INPV").otherwise("zz")
    other = F.when(priority == "1-URGENT", "PHY").when(priority == "5-LOW", "OTHER")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", codes.visit_code_by_type(kind).alias("code"), codes.visit_code_by_type(other).alias("other_code")
    )


@query(
    "visit_type_plan",
    with_views(
        "visits",
        f"""select 'coded' as mode, rowkey, {_TYPE} as VISIT_TYPE from visits
            union all select 'constant', rowkey, 'OUTPV' from visits
            union all select 'filtered', rowkey, 'INPV' from visits where VISIT_TYPE_CODE = '02'
            union all select 'none', rowkey, null from visits""",
    ),
)
def _(spark, sf_dir):
    visits = views.visits(spark, sf_dir).select("rowkey", "VISIT_TYPE_CODE")
    modes = {"coded": ("VISIT_TYPE", True), "constant": ("OUTPV", False), "filtered": ("INPV", True), "none": ("PHY", True)}
    parts = [
        codes.visit_type_plan(visits, field, part).select(F.lit(mode).alias("mode"), "rowkey", "VISIT_TYPE")
        for mode, (field, part) in modes.items()
    ]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


_PROVINCES_SQL = ", ".join(f"('{k}','{v}')" for k, v in codes.PROVINCES.items())


@query(
    "province_by_id",
    with_views(
        "patients",
        f"""select rowkey, ID_CARD_NO, d.name as province from patients
            left join (values {_PROVINCES_SQL}) d(prefix, name) on substr(ID_CARD_NO,1,2) = d.prefix""",
    ),
)
def _(spark, sf_dir):
    patients = views.patients(spark, sf_dir).select("rowkey", "ID_CARD_NO")
    return lookups.province_by_id(patients, "ID_CARD_NO")


@query(
    "enum_label",
    """select o_orderkey, case o_orderpriority when '1-URGENT' then 'at once' when '2-HIGH' then 'soon'
       when '3-MEDIUM' then 'normal' else '' end as label from orders""",
)
def _(spark, sf_dir):
    labels = [("1-URGENT", "urgent"), ("2-HIGH", "soon"), ("3-MEDIUM", "normal"), ("1-URGENT", "at once")]
    labelled = lookups.enum_label(table(spark, sf_dir, "orders"), "o_orderpriority", labels)
    return labelled.select("o_orderkey", "label")


@query(
    "age_band_count",
    with_views(
        "patients",
        """select case when age <= 6 then '0_6' when age <= 17 then '7_17' when age <= 28 then '18_28' when age <= 40 then '29_40'
           when age <= 65 then '41_65' else '66_' end as band, count(*) as n from (
           select 2024 - cast(substr(DATE_OF_BIRTH,1,4) as int) - case when substr(DATE_OF_BIRTH,6) > '06-15' then 1 else 0 end as age
           from patients) a group by band""",
    ),
)
def _(spark, sf_dir):
    return aggregates.age_band_count(views.patients(spark, sf_dir), "DATE_OF_BIRTH", F.lit(str(dt.date(2024, 6, 15))))
