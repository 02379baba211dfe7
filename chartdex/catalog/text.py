"""String, collection, JSON and XML queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartdex.catalog.registry import query, table
from chartdex.functions import text


@query("fix_mojibake", "select doc_id, text from documents")
def _(spark, sf_dir):
    spoiled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return table(spark, sf_dir, "documents").select("doc_id", text.fix_mojibake(spoiled).alias("text"))


# what can make a part of the driver texts blank
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(12288)"
_PARTS = f"""(select doc_id, case when contains(text,' ') then list_filter(string_split(text,' '), lambda w: trim(w, {_SPACES}) <> '')
  when text = '' then [] else [text] end as parts from documents) t"""


@query("split_list", f"select doc_id, cast(len(parts) as bigint) as n, array_to_string(parts,'|') as parts from {_PARTS}")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", text.split_list("text", " ").alias("parts"))
    return docs.select("doc_id", F.size("parts").cast("bigint").alias("n"), F.array_join("parts", "|").alias("parts"))


_FIRST_SEEN = "list_filter(parts, lambda w, i: list_position(parts, w) = i)"


@query(
    "split_list_distinct",
    f"select doc_id, cast(len({_FIRST_SEEN}) as bigint) as n, array_to_string({_FIRST_SEEN},'|') as parts from {_PARTS}",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", text.split_list_distinct("text", " ").alias("parts"))
    return docs.select("doc_id", F.size("parts").cast("bigint").alias("n"), F.array_join("parts", "|").alias("parts"))


@query(
    "split_map",
    """select p_partkey, unnest(['name','brand','size','empty']) as k,
       unnest([p_name, p_brand, cast(p_size + 1 as varchar), '']) as v from part""",
)
def _(spark, sf_dir):
    size = F.col("p_size")
    attributes = F.concat(
        F.lit("name:"), "p_name", F.lit(",size:"), size, F.lit(",brand:"), "p_brand", F.lit(":extra,flag,size:"), size + 1, F.lit(",empty:")
    )
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", F.explode(text.split_map(attributes, ",", ":")).alias("k", "v"))


def _triple(spark, sf_dir):
    parts = F.array(F.col("p_name"), F.nullif("p_type", F.lit("ECONOMY")), F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", parts.alias("parts"))


@query("list_to_string", "select p_partkey, p_name||','||coalesce(nullif(p_type,'ECONOMY'),'')||','||p_brand as joined from part")
def _(spark, sf_dir):
    return _triple(spark, sf_dir).select("p_partkey", text.list_to_string("parts", ",").alias("joined"))


@query("arr_to_string", "select p_partkey, p_name||'; '||coalesce(nullif(p_type,'ECONOMY'),'null')||'; '||p_brand as joined from part")
def _(spark, sf_dir):
    return _triple(spark, sf_dir).select("p_partkey", text.arr_to_string("parts", "; ").alias("joined"))


@query(
    "json_to_rows",
    """select event_id, k from (select event_id, event_type, cast(unnest([json_extract(props,'$.k'), to_json(user_id)]) as bigint) as k
       from events) t where event_type <> 'error'""",
)
def _(spark, sf_dir):
    array = F.concat(F.lit("["), "props", F.lit(',{"k":'), F.col("user_id").cast("string"), F.lit("}]"))
    body = F.when(F.col("event_type") == "error", "bad").otherwise(array)
    rows = table(spark, sf_dir, "events").select("event_id", F.explode(text.json_to_rows(body, "k bigint")).alias("r"))
    return rows.select("event_id", "r.k")


@query(
    "rows_to_json",
    """select c_custkey, '{"c_custkey":'||c_custkey||',"c_name":"'||c_name||'","segment":'||
       case c_mktsegment when 'BUILDING' then 'null' else '"'||c_mktsegment||'"' end||'}' as record,
       case when c_acctbal < 0 then '{}' else '["'||c_name||'",'||
       case c_mktsegment when 'BUILDING' then 'null' else '"'||c_mktsegment||'"' end||']' end as list from customer""",
)
def _(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    listed = F.when(F.col("c_acctbal") >= 0, F.array("c_name", "segment"))
    return customer.withColumn("handler", F.lit("x")).select(
        "c_custkey",
        text.record_to_json("c_custkey", "c_name", "segment", "handler").alias("record"),
        text.rows_to_json(listed).alias("list"),
    )


def _squeezed(xml):
    return F.regexp_replace(xml, r">\s+<", "><")


@query(
    "json_to_xml",
    """select event_id, case when event_type <> 'error' then '<o><k>'||json_extract_string(props,'$.k')||'</k></o>' end as xml from events""",
)
def _(spark, sf_dir):
    body = F.when(F.col("event_type") == "error", "bad").otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", _squeezed(text.json_to_xml(body, "k bigint")).alias("xml"))


@query(
    "json_to_xml_any_shape",
    """select event_id, case when event_type <> 'error' then '<o><id>'||cast(event_id as varchar)||'</id><l>1</l><l null="true"/><l><t>'||event_type
       ||'</t></l><p><k>'||json_extract_string(props,'$.k')||'</k></p></o>' end as xml from events""",
)
def _(spark, sf_dir):
    # objects in arrays in objects, a null and numbers; every event has a record of its own
    items = F.array(F.lit("1"), F.lit("null"), F.concat(F.lit('{"t":"'), "event_type", F.lit('"}')))
    fields = [F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"p":'), F.col("props"), F.lit(',"l":['), F.array_join(items, ","), F.lit("]}")]
    body = F.when(F.col("event_type") == "error", "{bad").otherwise(F.concat(*fields))
    return table(spark, sf_dir, "events").select("event_id", text.json_to_xml(body).alias("xml"))


@query(
    "map_to_xml",
    """select p_partkey, '<node><key label="name">'||p_name||'</key><key label="type">'||coalesce(nullif(p_type,'ECONOMY'),'null')
       ||'</key><key label="brand">'||p_brand||'</key></node>' as xml from part""",
)
def _(spark, sf_dir):
    kind = F.nullif("p_type", F.lit("ECONOMY"))
    entries = F.create_map(F.lit("name"), "p_name", F.lit("type"), kind, F.lit("brand"), "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", _squeezed(text.map_to_xml(entries)).alias("xml"))
