"""The registered queries of the training-data operators, and the SQL they agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from chartdex.llm import centroids, language_id, line_dedup, lm_score, mixing, near_dedup, nearest, packing, passages, personal_data, quality, sharding, spelling

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return put


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_register("op10_minimax_shards")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(_documents(spark, sf_dir), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


# DuckDB's regular expressions and ours agree on these classes
_SPACE = r"\x20\x09-\x0D"
_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TRIMMED = f"regexp_replace(regexp_replace(line, '^[{_SPACE}]+', ''), '[{_SPACE}]+$', '')"


@_register(
    "op1_line_dedup",
    f"""
    with lines as (
        select doc_id, i, line, {_ASCII_LOWER.format(_TRIMMED)} as key
        from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as i, ls[i] as line
              from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents))),
    frequent as (
        select key from (select distinct doc_id, key from lines) where key <> '' group by key having count(*) >= 10),
    marked as (select l.*, f.key is not null as lost from lines l left join frequent f using (key))
    select doc_id, count(*) as n_lines, count(*) filter (lost) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by i) filter (not lost), '')) as kept_sha256
    from marked group by doc_id
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"), min_docs=10)
    return kept.select("doc.doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


_RULE_SQL = {name: rule for name, rule in quality.RULES}


@_register(
    "op7_quality_rules",
    f"""
    with d as (
        select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') as w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) as ls
        from documents),
    windows as (
        select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as c
        from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)),
    covered as (
        select doc_id, count(distinct i + k) as n
        from windows, (select unnest([0, 1, 2]) as k) where c > 1 group by doc_id),
    m as (
        select d.doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
               len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, len(ls) as n_lines,
               len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words,
               len(list_filter(w, lambda x: not regexp_matches(x, '\\p{{L}}'))) as n_letterless
        from d left join covered c using (doc_id)),
    bits as (
        select *, {" + ".join(f"(case when {rule} then {1 << i} else 0 end)" for i, (_, rule) in enumerate(quality.RULES))} as fail_bits
        from m)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           fail_bits & {quality.BASE} <> 0 as base_failed, fail_bits & {quality.POLICIES["v1"]} = 0 as kept, fail_bits::bigint as fail_bits
    from bits
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.quality_ledger(_documents(spark, sf_dir).select("doc_id", "text"))
    return ledger.select(
        "doc.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality.passes("base")).alias("base_failed"),
        quality.passes("v1").alias("kept"),
        "fail_bits",
    )


@_register("op2_pareto_mix")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(_documents(spark, sf_dir), weights=(1, 2, 3), max_repeat=3, share=1.0)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


@_register("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir))


@_register(
    "op5_minhash_forest",
    f"""
    with recursive w as (
        select doc_id, regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^{_SPACE}]+') as w from documents),
    shingles as (
        select distinct doc_id, case when len(w) < 3 then array_to_string(w, ' ') else w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] end as s
        from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from w where len(w) > 0)),
    sizes as (select doc_id, count(*) as n from shingles group by doc_id),
    common as (
        select a.doc_id as x, b.doc_id as y, count(*) as i from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
        group by a.doc_id, b.doc_id),
    near as (
        select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * i >= 85 * (p.n + q.n - i)),
    links as (select x, y from near union all select y, x from near),
    reach as (
        select doc_id, doc_id as seen from documents
        union
        select reach.doc_id, links.y from reach join links on links.x = reach.seen)
    select d.doc_id, coalesce(any_value(n), 0) as n_shingles, min(seen) as component_id, min(seen) = d.doc_id as kept
    from documents d join reach using (doc_id) left join sizes using (doc_id) group by d.doc_id
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(_documents(spark, sf_dir), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@_register("op6_personal_data")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(_documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(*personal_data.BASE_KINDS))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in personal_data.BASE_KINDS],
        F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@_register("op9_deleted_interpolation")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(_documents(spark, sf_dir))


@_register("op8_kneser_ney_languages")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(_documents(spark, sf_dir))


@_register("op3_balanced_posting_lists")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest.nearest_neighbours(vectors, F.pmod("vec_id", F.lit(20)) == 0, k=20)


def _kmeans_sql(rounds: int) -> str:
    """Assignment and new centroids, round by round, over integer vectors in long form."""
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"""d{i} as (select v.i, c.c, sum((v.x - c.x) * (v.x - c.x))::bigint as d from v join c{i} c on v.dim = c.dim group by v.i, c.c),
            a{i} as (select i, c, d from d{i} qualify row_number() over (partition by i order by d, c) = 1)"""
        )
        if i < rounds:
            steps.append(
                f"""s{i} as (select a.c, v.dim, sum(v.x)::bigint as s, count(*) as n from v join a{i} a using (i) group by a.c, v.dim),
                c{i + 1} as (select o.c, o.dim, coalesce((s - ((s % n) + n) % n) // n, o.x) as x from c{i} o left join s{i} s on s.c = o.c and s.dim = o.dim)"""
            )
    return ", ".join(steps)


@_register(
    "op11_subvector_clusters",
    f"""
    with e as (
        select row_number() over () as i, vec_id, embedding from embeddings
        where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
    v as (
        select i, dim, floor(64 * embedding[dim]::double)::bigint as x
        from (select i, embedding, unnest(range(1, 65)) as dim from e)),
    first as (select i, row_number() over (order by sha256('1:' || vec_id)) - 1 as c from e qualify c < 16),
    c0 as (select first.c, v.dim, v.x from first join v using (i)),
    {_kmeans_sql(3)},
    digest as (select c, sha256(string_agg(x::varchar, ',' order by dim)) as centroid_sha256 from c3 group by c)
    select e.vec_id, a.c::int as cluster, a.d as distance, (sum(a.d) over (partition by a.c))::bigint as cluster_inertia,
           (sum(a.d) over ())::bigint as inertia, centroid_sha256
    from a3 a join e using (i) join digest using (c)
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return centroids.cluster_vectors(vectors, k=16, rounds=3, seed="1", dims=64, scale=64)


@_register("op12_suffix_passages")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.remove_passages(_documents(spark, sf_dir), length=400)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


@_register("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(_documents(spark, sf_dir), min_length=7, min_count=2, ratio=10, modulus=31)


@_register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
