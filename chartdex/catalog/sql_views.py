"""The views of ``chartdex.plans.views`` as SQL, to put in front of checking queries."""

from __future__ import annotations

_PID_C = "lpad(cast(c_custkey as varchar),8,'0')"
_PID_O = "lpad(cast(o_custkey as varchar),8,'0')"


def _key(pid: str, *rest: str) -> str:
    return "||'|'||".join([f"reverse(right({pid},4))||'|1.2.156|'||{pid}", *rest])


VIEWS = {
    "patients": f"""
 select {_key(_PID_C, "code", "cast(seq as varchar)")} as rowkey,
  'E'||{_PID_C} as EID, {_PID_C} as IN_PATIENT_ID, 'O'||{_PID_C} as OUT_PATIENT_ID,
  case when c_custkey%3=0 then '' else 'IN'||{_PID_C} end as INP_NO, 'OP'||{_PID_C} as OUTP_NO,
  c_name as PERSON_NAME, cast(c_custkey%2+1 as varchar) as SEX_CODE,
  case when c_custkey%2=0 then 'M' else 'F' end as SEX_NAME,
  cast(11+c_custkey%56 as varchar)||lpad(cast(c_custkey as varchar),16,'0') as ID_CARD_NO,
  case when c_custkey%5=0 then null else '555'||{_PID_C} end as HOME_PHONE,
  code as VISIT_TYPE_CODE, case when code='01' then 'OUTPV' else 'INPV' end as VISIT_TYPE_NAME,
  cast(1940+c_custkey%85 as varchar)||'-'||lpad(cast(1+c_custkey%12 as varchar),2,'0')||'-'||lpad(cast(1+c_custkey%28 as varchar),2,'0') as DATE_OF_BIRTH
 from (select *, unnest([1,2]) as seq from (select *, unnest(['01','02']) as code from customer) c) s
 where (seq=1 or c_custkey%50=0) and not (code='01' and c_custkey%10=0) and not (code='02' and c_custkey%7=0)""",
    "visits": f"""
 select {_key(_PID_O, "cast(o_orderkey as varchar)")} as rowkey, '1.2.156' as OID, 'G'||{_PID_O} as GLOBLE_ID,
  {_PID_O} as IN_PATIENT_ID, cast(o_orderkey as varchar) as VISIT_ID,
  case o_orderstatus when 'F' then '01' when 'O' then '02' else '03' end as VISIT_TYPE_CODE, 'E'||{_PID_O} as EID
 from orders""",
    "visit_records": f"""
 select {_key(_PID_O, "cast(l_orderkey as varchar)", "cast(l_linenumber as varchar)", "cast(l_partkey as varchar)", "cast(l_suppkey as varchar)", "cast(cast(l_quantity as int) as varchar)")} as rowkey,
  cast(l_orderkey as varchar) as VISIT_ID, 'D'||cast(l_suppkey as varchar) as REQUEST_DOCTOR,
  'P'||cast(l_suppkey%10 as varchar) as PARENT_DOCTOR, 'S'||cast(l_suppkey%3 as varchar) as SUPER_DOCTOR,
  l_returnflag as TMP_HOUSEMAN, 'DEPT'||cast(l_partkey%20 as varchar) as DEPT
 from lineitem join orders on l_orderkey=o_orderkey""",
    "adr_event": f"""
 select o_orderkey+1 as pk_event_id, 'EV-'||o_orderpriority as event_name, {_PID_O} as patient_id,
  cast(o_orderkey as varchar) as visit_id,
  case o_orderstatus when 'F' then 'OUTPV' when 'O' then 'INPV' else 'PHY' end as visit_type,
  c_name as person_name, case when c_custkey%2=0 then 'M' else 'F' end as sex,
  cast(c_nationkey as varchar) as dept_code, c_mktsegment as dept_name,
  cast(o_orderdate as varchar) as adt_time, o_orderpriority as diag,
  cast(o_orderdate as varchar) as monitor_time, o_orderstatus as status
 from orders join customer on o_custkey=c_custkey""",
    "adr_labinfo": """
 select l_orderkey+1 as pk_event_id, 'N'||cast(l_linenumber as varchar) as order_no,
  cast(l_partkey as varchar) as order_item_code, p_name as order_item_name,
  cast(l_suppkey as varchar) as lab_sub_item_code, p_type as lab_sub_item_name,
  cast(cast(l_quantity as int) as varchar) as lab_result_value, l_returnflag as lab_result_unit
 from lineitem join part on l_partkey=p_partkey""",
    "adr_drug": """
 select l_orderkey+1 as pk_event_id, 'N'||cast(l_linenumber as varchar) as order_no,
  cast(p_partkey as varchar) as drug_code, p_type as drug_type, p_name as drug_name,
  split_part(p_name,' ',1) as common_name, p_brand as license_no, 'M'||cast(l_suppkey as varchar) as manufacturer,
  l_linestatus as adr_usage, cast(o_orderdate as varchar)||'~'||cast(l_shipdate as varchar) as medication_start_end_time,
  cast(o_orderdate as varchar) as medication_start_time, cast(l_shipdate as varchar) as medication_end_time
 from lineitem join orders on l_orderkey=o_orderkey join part on l_partkey=p_partkey""",
}

# the third key part of a master or record row, and of a visit's patient
PREFIX_OF_ROWKEY = "split_part({0}.rowkey,'|',1)||'|'||split_part({0}.rowkey,'|',2)||'|'||split_part({0}.rowkey,'|',3)"
PREFIX_OF_PATIENT = "reverse(right({0}.IN_PATIENT_ID,4))||'|1.2.156|'||{0}.IN_PATIENT_ID"


def with_views(names: str, body: str, *more: str) -> str:
    """Prepend the named views, then ``more`` common table expressions, to a query."""
    parts = [f"{n} as ({VIEWS[n]})" for n in names.split()] + list(more)
    return f"with {', '.join(parts)} {body}"
