"""One key holding a third of all rows is split over tasks, and every row stays."""

import pytest
from pyspark.sql import functions as F

from chartdex.operators import lookups, tables
from chartdex.operators.joins import matching
from chartdex.operators.numbering import number_within
from chartdex.plans.index_job import patient_list_index

MASTER_CELLS = ["EID", "VISIT_TYPE_NAME", "INP_NO", "OUTP_NO", "PERSON_NAME", "SEX_CODE", "SEX_NAME", "ID_CARD_NO", "HOME_PHONE", "DATE_OF_BIRTH"]
HOT, OTHERS, ROWS = "00000000", 2000, 120_000


@pytest.fixture
def small_partitions(spark):
    """Sizes at which the rows below count as skewed, and no broadcast to hide it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def visit_rows(spark):
    i = F.col("id")
    pid = F.when(i % 3 == 0, HOT).otherwise(F.lpad((i % OTHERS).cast("string"), 8, "0"))
    return spark.range(0, ROWS, numPartitions=8).select(
        F.concat_ws("|", F.sha2(i.cast("string"), 256), i.cast("string")).alias("rowkey"),
        F.lit("o").alias("OID"),
        F.lit("g").alias("GLOBLE_ID"),
        pid.alias("IN_PATIENT_ID"),
        i.cast("string").alias("VISIT_ID"),
        F.lit("02").alias("VISIT_TYPE_CODE"),
        F.concat(F.lit("E"), pid).alias("EID"),
    )


def master_rows(spark, per_patient=1):
    pid = F.lpad(F.col("id").cast("string"), 8, "0")
    rest = ["INP_NO", "OUTP_NO", "PERSON_NAME", "SEX_CODE", "SEX_NAME", "ID_CARD_NO", "HOME_PHONE", "DATE_OF_BIRTH"]
    rows = spark.range(OTHERS).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(per_patient))))
    return rows.select(
        F.concat_ws("|", F.reverse(F.right(pid, F.lit(4))), F.lit("o"), pid, F.col("n").cast("string")).alias("rowkey"),
        F.concat(F.lit("E"), pid).alias("EID"),
        pid.alias("IN_PATIENT_ID"),
        pid.alias("OUT_PATIENT_ID"),
        F.lit("02").alias("VISIT_TYPE_CODE"),
        F.lit("INPV").alias("VISIT_TYPE_NAME"),
        *[F.lit(c.lower()).alias(c) for c in rest],
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_visit_lookup_splits_the_hot_patient(spark, small_partitions):
    docs = lookups.lookup_inpatient(visit_rows(spark), master_rows(spark), "o")
    counted = docs.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("visit_rowkey"))
    assert "SortMergeJoin(skew=true)" in final_plan(counted)
    assert docs.count() == ROWS
    assert counted.where(F.col("id") == f"{HOT}|02").first()["n"] >= ROWS // 3


def test_doctor_lookup_splits_a_hot_visit(spark, small_partitions):
    visits = visit_rows(spark).withColumn("VISIT_ID", F.lit("1"))
    records = master_rows(spark).select("rowkey", F.lit("1").alias("VISIT_ID"), *[F.col("EID").alias(c) for c in lookups.DOCTOR_FIELDS])
    found = lookups.lookup_doctors(visits, records, "o")
    counted = found.groupBy("DEPT").agg(F.count(F.lit(1)).alias("n"), F.max("rowkey"))
    assert "SortMergeJoin(skew=true)" in final_plan(counted)
    assert found.where(F.col("DEPT").isNotNull()).count() == ROWS


def test_multi_value_documents_split_the_hot_patient(spark, small_partitions):
    docs = lookups.multi_value_docs(visit_rows(spark), master_rows(spark, 2), "o", part_size=1)
    counted = docs.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max("visit_rowkey"))
    assert "SortMergeJoin(skew=true)" in final_plan(counted)
    assert {r["part"]: r["n"] for r in counted.collect()} == {0: ROWS, 1: ROWS}


def test_index_job_reduces_the_hot_patient_before_the_shuffle(spark, small_partitions):
    docs = {r["id"]: r["VISIT_ID"] for r in patient_list_index(visit_rows(spark), master_rows(spark), "o").collect()}
    assert len(docs) == OTHERS and docs[f"{HOT}|02"] == str(ROWS - 3)


def tasks_of_hot_rows(df, hot):
    """How many tasks hold the rows of the hot key."""
    return df.select(hot.alias("hot"), F.spark_partition_id().alias("task")).where("hot").distinct().count()


def test_numbering_within_a_hot_group(spark, small_partitions):
    rows = visit_rows(spark).select("IN_PATIENT_ID", F.col("VISIT_ID").cast("bigint").alias("v"), "rowkey")
    numbered = number_within(rows, ["IN_PATIENT_ID"], ["v"], "n")
    assert tasks_of_hot_rows(numbered, F.col("IN_PATIENT_ID") == HOT) >= 3
    sums = numbered.groupBy("IN_PATIENT_ID").agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("last"), F.countDistinct("n").alias("distinct"))
    assert sums.where((F.col("rows") != F.col("last")) | (F.col("rows") != F.col("distinct"))).count() == 0


def test_multi_value_documents_with_a_hot_master(spark, small_partitions):
    i = F.col("id")
    pid = F.when(i % 3 == 0, HOT).otherwise(F.lpad((i % OTHERS).cast("string"), 8, "0"))
    code = F.lit("02")
    rows = spark.range(0, 30_000, numPartitions=8).select(
        F.concat_ws("|", F.reverse(F.right(pid, F.lit(4))), F.lit("o"), pid, code, i.cast("string")).alias("rowkey"),
        pid.alias("IN_PATIENT_ID"), pid.alias("OUT_PATIENT_ID"), code.alias("VISIT_TYPE_CODE"),
        *[F.sha2(F.concat(F.lit(c), i.cast("string")), 256).alias(c) for c in MASTER_CELLS],
    )
    visits = visit_rows(spark).where(F.col("VISIT_ID") < "2").limit(3).withColumn("IN_PATIENT_ID", F.lit(HOT))
    docs = lookups.multi_value_docs(visits, rows, "o", part_size=1000)
    sizes = [r["n"] for r in docs.select(F.size("id").alias("n")).collect()]
    assert max(sizes) == 1000 and sum(sizes) == 3 * rows.where(F.col("IN_PATIENT_ID") == HOT).count()
    masters = lookups.master_documents(rows)
    parted = lookups._in_parts(masters, 1000)
    assert tasks_of_hot_rows(parted, F.col("IN_PATIENT_ID") == HOT) >= 3


@pytest.mark.parametrize("present", [True, False])
def test_membership_in_an_aggregated_key_table(spark, small_partitions, present):
    rows = visit_rows(spark)
    keys = rows.groupBy("IN_PATIENT_ID").count().where(F.col("count") > 1000)
    kept = matching(rows, keys, "IN_PATIENT_ID", present, aggregated=True)
    assert "skew=true" in final_plan(kept.groupBy("OID").agg(F.max("rowkey")))
    hot = ROWS // 3 + rows.where((F.col("IN_PATIENT_ID") == HOT) & (F.col("VISIT_ID") % 3 != 0)).count()
    assert kept.count() == (hot if present else ROWS - hot)


def test_upsert_with_a_hot_id(spark, small_partitions):
    visits = visit_rows(spark).select(F.col("IN_PATIENT_ID").alias("id"), F.col("VISIT_ID").cast("bigint").alias("v"))
    current = spark.createDataFrame([(HOT, -1), ("kept", -2)], "id string, v bigint")
    after = {r["id"]: r["v"] for r in tables.upsert_by_id(current, visits, ["v"]).collect()}
    assert after[HOT] == ROWS - 3 and after["kept"] == -2 and len(after) == OTHERS + 1


@pytest.mark.parametrize("known", [True, False])
def test_children_of_a_hot_event_or_of_none_are_split_and_not_sorted(spark, small_partitions, known):
    children = visit_rows(spark).select(F.col("IN_PATIENT_ID").alias("natural"), "rowkey")
    events = master_rows(spark).select(F.col("IN_PATIENT_ID").alias("natural"), F.monotonically_increasing_id().alias("pk_event_id"))
    keyed = tables.with_event_keys(children, events if known else events.where(F.col("natural") != HOT), ["natural"])
    counted = keyed.groupBy("pk_event_id").agg(F.count(F.lit(1)).alias("n"), F.max("rowkey"))
    plan = final_plan(counted)
    assert "ShuffledHashJoin(skew=true)" in plan and "SortMergeJoin" not in plan
    assert keyed.count() == ROWS
    found = {r["pk_event_id"]: r["n"] for r in counted.collect()}
    assert len(found) == OTHERS and max(found.values()) >= ROWS // 3 and (None in found) != known
