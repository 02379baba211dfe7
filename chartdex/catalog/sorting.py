"""Sort and distinct-list queries; the position in the order is part of the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartdex.catalog.registry import query, table
from chartdex.functions import text
from chartdex.operators import ordering


@query(
    "sort_multi",
    """select row_number() over (order by o_orderpriority, o_totalprice desc, o_orderkey) as rank, o_orderkey, o_orderpriority from orders""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    order = ordering.multi_order(["o_orderpriority", "o_totalprice"], ["asc", "desc"])
    return ordering.with_rank(orders, order, "o_orderkey").select("rank", "o_orderkey", "o_orderpriority")


_DATED = "select o_orderkey, case o_orderstatus when 'P' then ' ' else strftime(o_orderdate,'%Y-%m-%d') end as day from orders"


@query(
    "sort_desc_by_date",
    f"""select row_number() over (order by case when trim(day) = '' then '1900-01-01' else day end desc, o_orderkey) as rank,
        o_orderkey, day from ({_DATED}) t""",
)
def _(spark, sf_dir):
    day = F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"))
    return ordering.with_rank(orders, ordering.date_desc_order("day"), "o_orderkey").select("rank", "o_orderkey", "day")


_NAMED = "select p_partkey, case p_type when 'ECONOMY' then null when 'PROMO' then '  ' else p_name end as name from part"


def _named(spark, sf_dir):
    kind = F.col("p_type")
    name = F.when(kind == "PROMO", "  ").when(kind != "ECONOMY", F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))


for _name, _direction, _sql in (("sort_by", None, ""), ("sort_by_desc", "down", "desc")):

    @query(
        _name,
        f"""select row_number() over (order by coalesce(nullif(trim(name),''),'') {_sql}, p_partkey) as rank, p_partkey, name
            from ({_NAMED}) t""",
    )
    def _(spark, sf_dir, direction=_direction):
        order = ordering.text_order("name", direction)
        return ordering.with_rank(_named(spark, sf_dir), order, "p_partkey").select("rank", "p_partkey", "name")


@query(
    "sort_ints",
    """select doc_id, array_to_string(list_sort(n), ',') as ascending, array_to_string(list_reverse_sort(n), ',') as descending
       from (select doc_id, list_transform(string_split(text, ' '), lambda w: length(w)) as n from documents) t""",
)
def _(spark, sf_dir):
    lengths = F.transform(F.split("text", " "), lambda w: F.length(w))
    docs = table(spark, sf_dir, "documents").select("doc_id", lengths.alias("n"))
    both = {"ascending": "asc", "descending": "desc"}
    return docs.select(
        "doc_id",
        *[F.array_join(ordering.sort_ints("n", d).cast("array<string>"), ",").alias(c) for c, d in both.items()],
    )


_FIRST_SEEN = "list_filter(words, lambda w, i: list_position(words, w) = i)"


@query(
    "list_distinct",
    f"""select doc_id, cast(len({_FIRST_SEEN}) as bigint) as n, array_to_string({_FIRST_SEEN}, ' ') as words
        from (select doc_id, string_split(text, ' ') as words from documents) t""",
)
def _(spark, sf_dir):
    words = text.list_distinct(F.split("text", " "))
    docs = table(spark, sf_dir, "documents").select("doc_id", words.alias("words"))
    return docs.select("doc_id", F.size("words").cast("bigint").alias("n"), F.array_join("words", " ").alias("words"))
