"""Filter and predicate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartdex.catalog.registry import query, table
from chartdex.functions import dates, text
from chartdex.functions.blank import is_blank
from chartdex.operators import filters
from chartdex.operators.filters import FilterSpec

# part with a type column that misses cells
_PART = "(select p_partkey, p_name, p_brand, nullif(p_type,'ECONOMY') as p_type, p_size from part) p"


def _part(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return part.withColumn("p_type", F.nullif("p_type", F.lit("ECONOMY")))


def _register(name: str, spec: FilterSpec, condition: str) -> None:
    @query(name, f"select p_partkey, p_name, p_brand, p_type from {_PART} where {condition}")
    def _(spark, sf_dir):
        return filters.filter_rows(_part(spark, sf_dir), spec).select("p_partkey", "p_name", "p_brand", "p_type")


_register("filter_eq", FilterSpec("p_type", "=", "PROMO"), "p_type = 'PROMO'")
_register("filter_gt", FilterSpec("p_size", ">", "3"), "cast(p_size as varchar) > '3'")
_register("filter_ge", FilterSpec("p_size", ">=", "3"), "cast(p_size as varchar) >= '3'")
_register("filter_lt", FilterSpec("p_size", "<", "3"), "cast(p_size as varchar) < '3'")
_register("filter_le", FilterSpec("p_size", "<=", "3"), "cast(p_size as varchar) <= '3'")
_register("filter_ne", FilterSpec("p_type", "<>", "PROMO"), "p_type <> 'PROMO'")
_register("filter_like", FilterSpec("p_name", "like", "ring"), "contains(p_name, 'ring')")
_register("filter_like_regex", FilterSpec("p_name", "like", "r.ng|^small", regex=True), "regexp_matches(p_name, 'r.ng|^small')")
_register("filter_nlike", FilterSpec("p_type", "nlike", "AR"), "not contains(p_type, 'AR')")
_register("filter_inlike", FilterSpec("p_name", "inlike", "red,widget"), "contains(p_name, 'red') or contains(p_name, 'widget')")
_register("filter_in", FilterSpec("p_type", "in", "PROMO,LARGE,ECONOMY"), "p_type in ('PROMO','LARGE','ECONOMY')")
_register("filter_nin", FilterSpec("p_type", "nin", "PROMO,LARGE"), "p_type not in ('PROMO','LARGE')")
_register("filter_sw", FilterSpec("p_name", "sw", "red,small"), "starts_with(p_name,'red') or starts_with(p_name,'small')")
_register("filter_ew", FilterSpec("p_brand", "ew", "1,7"), "suffix(p_brand,'1') or suffix(p_brand,'7')")
_register("filter_isnull", FilterSpec("p_type", "isnull"), "p_type is null")
_register("filter_notnull", FilterSpec("p_type", "notnull"), "p_type is not null")
_register("filter_rdd", FilterSpec("p_type", "<=", "PROMO"), "p_type <= 'PROMO'")
_register("filter_typed", FilterSpec("p_size", ">", "30", "INT"), "p_size > 30")


@query("filter_typed_date", "select o_orderkey, o_custkey from orders where o_orderdate >= timestamp '1999-06-15 00:00:00'")
def _(spark, sf_dir):
    spec = FilterSpec("o_orderdate", ">=", "1999-06-15 00:00:00", "DATE")
    return filters.filter_rows(table(spark, sf_dir, "orders"), spec).select("o_orderkey", "o_custkey")


_LISTED = "(select c_custkey from customer where c_mktsegment = 'BUILDING')"
for _name, _negate in (("filter_in_table", False), ("filter_nin_table", True)):

    @query(_name, f"select o_orderkey, o_custkey from orders where o_custkey {'not in' if _negate else 'in'} {_LISTED}")
    def _(spark, sf_dir, negate=_negate):
        values = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        return filters.in_table(orders, "o_custkey", values, negate)


@query("filter_string_value", f"select p_partkey, p_name, p_type from {_PART} where p_type = 'PROMO' and p_brand <> 'Brand#2'")
def _(spark, sf_dir):
    specs: list[FilterSpec] = []
    filters.add_string_filter("p_type", "PROMO", "=", specs)
    filters.add_string_filter("p_brand", "Brand#2", "<>", specs)
    return filters.filter_rows(_part(spark, sf_dir), *specs).select("p_partkey", "p_name", "p_type")


@query(
    "filter_from_text",
    f"""select p_partkey, p_name, p_type from {_PART}
        where p_type in ('PROMO','LARGE') and starts_with(p_name,'red') and contains(p_brand, '1')""",
)
def _(spark, sf_dir):
    specs = filters.specs_from_text("p_type|in|PROMO,LARGE;p_size|=|;p_name|sw|red;p_brand|like|1", ";")
    return filters.filter_rows(_part(spark, sf_dir), *specs).select("p_partkey", "p_name", "p_type")


@query(
    "filter_blank",
    """select doc_id, line_no, case when line is null or trim(line, ' ' || chr(9) || chr(12288)) = '' then 1 else 0 end as blank
       from (select doc_id, unnest(string_split(text, chr(10))) as line,
                    unnest(generate_series(1, len(string_split(text, chr(10))))) as line_no from documents) l""",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select(
        "doc_id", (F.col("pos") + 1).cast("bigint").alias("line_no"), is_blank("line").cast("bigint").alias("blank")
    )


_SYMBOL_SQL = "case l_linenumber when 1 then '>' when 2 then '≥' when 3 then '=' when 4 then '≤' when 5 then '<' when 6 then '≠' else '?' end"


@query(
    "compare_values",
    f"""select symbol, l_partkey, count(*) as n, count(*) filter (where result) as n_true from (
        select l_partkey, {_SYMBOL_SQL} as symbol, case l_linenumber
          when 1 then l_quantity > 25 when 2 then l_quantity >= 25 when 3 then l_quantity = 25 when 4 then l_quantity <= 25
          when 5 then l_quantity < 25 when 6 then l_quantity <> 25 else false end as result from lineitem) t
        group by symbol, l_partkey""",
)
def _(spark, sf_dir):
    symbols = F.array(*[F.lit(s) for s in text.SYMBOLS])
    symbol = F.coalesce(F.get(symbols, F.col("l_linenumber") - 1), F.lit("?"))
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", symbol.alias("symbol"), "l_quantity")
    result = text.compare_values("l_quantity", F.lit(25.0), F.col("symbol"))
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(result).alias("n_true")]
    return rows.groupBy("symbol", "l_partkey").agg(*counts)


@query(
    "date_compare",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate >= o_orderdate as bigint) as not_before
       from lineitem join orders on l_orderkey = o_orderkey""",
)
def _(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        dates.date_compare("l_shipdate", "o_orderdate").cast("bigint").alias("not_before"),
    )


@query(
    "is_number",
    """select p_partkey, txt, cast(try_cast(txt as double) is not null as bigint) as ok from (
       select p_partkey, unnest([cast(p_size as varchar), p_name, cast(p_size as varchar)||'e3', ' '||cast(p_size as varchar)||' ',
       '-'||cast(p_retailprice as varchar), p_brand, '1.2.'||cast(p_size as varchar), '']) as txt from part) t""",
)
def _(spark, sf_dir):
    size = F.col("p_size").cast("string")
    texts = F.array(
        size, "p_name", F.concat(size, F.lit("e3")), F.concat(F.lit(" "), size, F.lit(" ")),
        F.concat(F.lit("-"), F.col("p_retailprice").cast("string")), "p_brand", F.concat(F.lit("1.2."), size), F.lit(""),
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", F.explode(texts).alias("txt"))
    return rows.withColumn("ok", text.is_number("txt").cast("bigint"))
