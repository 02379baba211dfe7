"""Projection, reshaping and key queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartdex.catalog.registry import query, table
from chartdex.catalog.sql_views import with_views
from chartdex.functions import blank, codes, keys
from chartdex.operators import reshape
from chartdex.plans import views


@query("cell_value", "select c_custkey, cast(c_nationkey as varchar) as nation, cast(null as varchar) as absent from customer")
def _(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    cells = [reshape.cell_value(customer, "c_nationkey").alias("nation"), reshape.cell_value(customer, "c_nothing").alias("absent")]
    return customer.select("c_custkey", *cells)


_BLANKED = """select c_custkey, case c_mktsegment when 'BUILDING' then '' when 'MACHINERY' then null when 'FURNITURE' then '  ' else c_mktsegment end as a,
              case when c_acctbal < 0 then '' else c_name end as b, cast(c_nationkey as varchar) as c from customer"""


@query("first_nonempty", f"select c_custkey, coalesce(nullif(a,''), nullif(b,''), nullif(c,'')) as value from ({_BLANKED}) t")
def _(spark, sf_dir):
    segment = F.col("c_mktsegment")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(segment == "BUILDING", "")
        .when(segment == "MACHINERY", F.lit(None))
        .when(segment == "FURNITURE", "  ")
        .otherwise(segment)
        .alias("a"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name")).alias("b"),
        F.col("c_nationkey").cast("string").alias("c"),
    )
    return rows.select("c_custkey", blank.first_nonempty("a", "b", "c").alias("value"))


@query(
    "identifier_fields",
    with_views(
        "patients",
        """select rowkey, coalesce(nullif(IN_PATIENT_ID,''), nullif(OUT_PATIENT_ID,'')) as patient,
           coalesce(nullif(INP_NO,''), nullif(OUTP_NO,'')) as hospital_no, cast(null as varchar) as card,
           cast(null as varchar) as case_no, cast(null as varchar) as unknown from patients""",
    ),
)
def _(spark, sf_dir):
    patients = views.patients(spark, sf_dir)
    kinds = {
        "patient": "PATIENT_IDENTIFIER",
        "hospital_no": "HOSPTIAL_NO",
        "card": "HEALTH_CARD_NO",
        "case_no": "CASE_NO",
        "unknown": "PASSPORT",
    }
    return patients.select("rowkey", *[reshape.identifier_value(patients, k).alias(n) for n, k in kinds.items()])


_KV = """select cast(o_custkey as varchar) as key,
         case o_orderpriority when '3-MEDIUM' then ' ' when '5-LOW' then null else o_orderpriority end as value,
         o_orderkey from orders"""


def _kv_source(spark, sf_dir):
    priority = F.col("o_orderpriority")
    value = F.when(priority == "3-MEDIUM", " ").when(priority == "5-LOW", F.lit(None)).otherwise(priority)
    return table(spark, sf_dir, "orders").select("o_custkey", value.alias("priority"), "o_orderkey")


@query("to_kv", f"select key, value from ({_KV}) t where trim(value) <> ''")
def _(spark, sf_dir):
    return reshape.to_kv(_kv_source(spark, sf_dir), "o_custkey", "priority")


@query("to_kv_dedup", f"select key, arg_min(value, o_orderkey) as value from ({_KV}) t where trim(value) <> '' group by key")
def _(spark, sf_dir):
    return reshape.to_kv_dedup(_kv_source(spark, sf_dir), "o_custkey", "priority", order="o_orderkey")


@query("group_first", f"select key, min(value) as value from ({_KV}) t where trim(value) <> '' group by key")
def _(spark, sf_dir):
    return reshape.group_first(reshape.to_kv(_kv_source(spark, sf_dir), "o_custkey", "priority"))


@query(
    "to_keyed_map",
    """select cast(c_custkey as varchar) as key, unnest(['rowkey','c_name','c_mktsegment']) as field,
       unnest([cast(c_custkey as varchar), c_name, c_mktsegment]) as value from customer""",
)
def _(spark, sf_dir):
    records = reshape.to_keyed_map(table(spark, sf_dir, "customer"), "c_name", "c_mktsegment", rowkey="c_custkey")
    return records.select("key", F.explode("record").alias("field", "value"))


@query(
    "to_renamed_map",
    with_views(
        "patients",
        """select coalesce(nullif(IN_PATIENT_ID,''), nullif(OUT_PATIENT_ID,'')) as key, rowkey,
           PERSON_NAME as name, HOME_PHONE as phone, cast(null as varchar) as email from patients""",
    ),
)
def _(spark, sf_dir):
    mappings = {"name": "PERSON_NAME", "phone": "HOME_PHONE", "email": "EMAIL"}
    return reshape.to_renamed_map(views.patients(spark, sf_dir), mappings)


_MAP = """select p_partkey, unnest(['name','type','brand','']) as field,
          unnest([p_name, case when p_size > 25 then ' ' else p_type end, case when p_size < 10 then null else p_brand end, 'x']) as value from part"""


def _part_map(spark, sf_dir):
    size = F.col("p_size")
    entries = F.create_map(
        F.lit("name"), F.col("p_name"),
        F.lit("type"), F.when(size > 25, " ").otherwise(F.col("p_type")),
        F.lit("brand"), F.when(size >= 10, F.col("p_brand")),
        F.lit(""), F.lit("x"),
    )
    return table(spark, sf_dir, "part").select("p_partkey", entries.alias("entries"))


@query("put_to_map", f"select p_partkey, field, value from ({_MAP}) t where trim(field) <> '' and trim(value) <> ''")
def _(spark, sf_dir):
    return _part_map(spark, sf_dir).select("p_partkey", F.explode(reshape.put_to_map("entries")).alias("field", "value"))


@query("put_field_to_map", f"select p_partkey, field, value from ({_MAP}) t where value is not null")
def _(spark, sf_dir):
    kept = reshape.put_field_to_map("entries")
    return _part_map(spark, sf_dir).select("p_partkey", F.explode(kept).alias("field", "value"))


_FILL = """select p_partkey,
  case when p_type = 'ECONOMY' then null when p_type = 'PROMO' then '-' else p_type end as old,
  case when p_size > 40 then ' ' else p_brand end as val from part"""


@query(
    "fill_replace",
    f"""select p_partkey,
        case when old is null or old = '-' then case when trim(val) = '' then '-' else val end else old end as kept,
        case when trim(val) = '' then '-' else val end as updated,
        case when old is null then case when trim(val) = '' then old else val end else old end as plain,
        case when trim(val) = '' then old else val end as plain_updated from ({_FILL}) t""",
)
def _(spark, sf_dir):
    kind = F.col("p_type")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(kind == "PROMO", "-").when(kind != "ECONOMY", kind).alias("old"),
        F.when(F.col("p_size") > 40, " ").otherwise(F.col("p_brand")).alias("val"),
    )
    return rows.select(
        "p_partkey",
        blank.fill_replace("old", "val", "-", False).alias("kept"),
        blank.fill_replace("old", "val", "-", True).alias("updated"),
        blank.fill_replace("old", "val", None, False).alias("plain"),
        blank.fill_replace("old", "val", None, True).alias("plain_updated"),
    )


@query(
    "obj_to_str",
    """select p_partkey, coalesce(t,'') as plain, coalesce(t,'none') as with_default,
       case when t is null or t = 'PROMO' then 'other' else t end as replaced
       from (select p_partkey, nullif(p_type,'ECONOMY') as t from part) p""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.nullif("p_type", F.lit("ECONOMY")).alias("t"))
    return rows.select(
        "p_partkey",
        blank.obj_to_str("t").alias("plain"),
        blank.obj_to_str("t", "none").alias("with_default"),
        blank.obj_to_str("t", "PROMO", "other").alias("replaced"),
    )


@query("copy_nonblank", "select p_partkey, case when p_size > 25 then null else p_brand end as brand_copy from part")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("brand", F.when(F.col("p_size") > 25, " ").otherwise(F.col("p_brand")))
    copied = reshape.copy_nonblank(reshape.copy_nonblank(part, "brand", "brand_copy"), "brand", " ")
    return copied.select("p_partkey", "brand_copy")


@query(
    "salt",
    """select c_custkey, reverse(right(c_name,4)) as tail, reverse(substr(c_name,1,4)) as head,
       case when length(id) < 4 then 'zzzz' else reverse(right(id,4)) end as short_tail,
       case when length(id) < 3 then 'zzzz' else reverse(substr(id,1,3)) end as short_head,
       reverse(substr(c_name, length(c_name)-3, 3)) as inner_tail
       from (select c_custkey, c_name, cast(c_custkey as varchar) as id from customer) c""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("id", F.col("c_custkey").cast("string"))
    return rows.select(
        "c_custkey",
        keys.salt("c_name").alias("tail"),
        keys.salt("c_name", 0, 4).alias("head"),
        keys.salt("id").alias("short_tail"),
        keys.salt("id", 0, 3).alias("short_head"),
        keys.salt("c_name", -4, -1).alias("inner_tail"),
    )


_ID = "lpad(cast(c_custkey as varchar),8,'0')"


@query("rowkey_prefix", f"select c_custkey, reverse(right({_ID},4))||'|9.8|'||{_ID} as prefix from customer")
def _(spark, sf_dir):
    pid = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    return table(spark, sf_dir, "customer").select("c_custkey", keys.rowkey_prefix(pid, "9.8").alias("prefix"))


@query(
    "visit_rowkey_prefix",
    with_views("visits", "select rowkey, reverse(right(EID,4))||'|1.2.156|'||EID as prefix from visits"),
)
def _(spark, sf_dir):
    return views.visits(spark, sf_dir).select("rowkey", keys.visit_rowkey_prefix("EID", views.OID).alias("prefix"))


@query(
    "visit_rowkey",
    with_views(
        "visits",
        """select rowkey, case when VISIT_TYPE_CODE <> '03' then
           reverse(right(EID,4))||'|1.2.156|'||EID||'|'||case VISIT_TYPE_CODE when '01' then 'OUTPV' else 'INPV' end
           ||'|'||VISIT_ID||'|'||IN_PATIENT_ID end as visit_key from visits""",
    ),
)
def _(spark, sf_dir):
    kind = F.when(F.col("VISIT_TYPE_CODE") == "03", " ").otherwise(codes.visit_type_by_code("VISIT_TYPE_CODE"))
    key = keys.visit_rowkey("IN_PATIENT_ID", kind, "VISIT_ID", "EID", views.OID)
    return views.visits(spark, sf_dir).select("rowkey", key.alias("visit_key"))
