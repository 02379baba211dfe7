"""Batched writes, key-sorted tables and the XML sink."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from chartdex.sources import scans, sinks


def file_flush(folder):
    def flush(batch):
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as out:
            json.dump([r["id"] for r in batch], out)

    return flush


def test_batches_per_partition(spark, tmp_path):
    docs = spark.range(0, 2500, numPartitions=2)
    sinks.write_batched(docs, file_flush(str(tmp_path)), batch_size=1000)
    batches = [json.load(open(f)) for f in tmp_path.iterdir()]
    assert sorted(len(b) for b in batches) == [250, 250, 1000, 1000]
    assert sorted(i for b in batches for i in b) == list(range(2500))


def test_failed_flush_fails_the_job(spark):
    def flush(batch):
        raise ValueError("index is down")

    with pytest.raises(Exception, match="index is down"):
        sinks.write_batched(spark.range(10), flush)


def test_batch_files(spark, tmp_path):
    path = str(tmp_path / "batches")
    sinks.write_batch_files(spark.range(0, 2500, numPartitions=1), path)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) == 3 and spark.read.parquet(path).count() == 2500


def test_key_sorted_table_prunes_prefix_scans(spark, tmp_path):
    path = str(tmp_path / "keyed")
    rows = spark.range(2000).select(F.format_string("%04d|o|%d", "id", "id").alias("rowkey"), F.col("id").alias("v"))
    sinks.write_by_key(rows.repartition(4, F.rand(1)), path)
    stored = spark.read.parquet(path)
    found = scans.scan_prefix(stored, "0012", [], "v")
    assert [r["v"] for r in found.collect()] == [12]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rowkey,0012)" in plan and "LessThan(rowkey,0012})" in plan


def test_xml_sink_round_trip(spark, tmp_path):
    path = str(tmp_path / "xml")
    rows = spark.range(50).select(F.create_map(F.lit("k"), F.col("id").cast("string"), F.lit("n"), F.lit(None).cast("string")).alias("m"))
    sinks.write_map_xml(rows, "m", path)
    back = spark.read.format("xml").option("rowTag", "node").schema("key array<struct<_VALUE:string,_label:string>>").load(path)
    got = {r["key"][0]["_VALUE"]: [(e["_label"], e["_VALUE"]) for e in r["key"]] for r in back.collect()}
    assert got == {str(i): [("k", str(i)), ("n", "null")] for i in range(50)}


def test_index_job_pushes_every_document_once(spark, sf_dir, tmp_path):
    from chartdex.plans import views
    from chartdex.plans.index_job import patient_list_index, run_index_job

    tables = views.visits(spark, sf_dir), views.patients(spark, sf_dir)
    run_index_job(*tables, views.OID, file_flush(str(tmp_path)), batch_size=100)
    batches = [json.load(open(f)) for f in tmp_path.iterdir()]
    ids = sorted(r["id"] for r in patient_list_index(*tables, views.OID).collect())
    assert sorted(i for b in batches for i in b) == ids and max(map(len, batches)) <= 100


def test_stored_masters_join_without_a_shuffle(spark, sf_dir, tmp_path):
    from chartdex.plans import views
    from chartdex.plans.index_job import index_documents, patient_list_index, save_masters

    visits, patients = views.visits(spark, sf_dir), views.patients(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        save_masters(patients, "masters", 8, str(tmp_path / "masters"))
        stored = index_documents(visits, spark.table("masters"), views.OID)
        fresh = patient_list_index(visits, patients, views.OID)
        counts = [d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for d in (stored, fresh)]
        assert counts[0] == counts[1] - 1
        assert sorted(map(str, stored.collect())) == sorted(map(str, fresh.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table if exists masters")


def test_one_patient_reads_only_their_key_range(spark, sf_dir, tmp_path):
    from chartdex.plans import views
    from chartdex.plans.index_job import patient_list_index

    visits, path = views.visits(spark, sf_dir), str(tmp_path / "patients")
    sinks.write_by_key(views.patients(spark, sf_dir), path)
    docs = patient_list_index(visits, spark.read.parquet(path), views.OID, patient_id="00000012")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = docs._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(rowkey,2100|1.2.156|00000012|)" in plan
    whole = patient_list_index(visits, views.patients(spark, sf_dir), views.OID)
    assert sorted(map(str, docs.collect())) == sorted(map(str, whole.where(F.col("IN_PATIENT_ID") == "00000012").collect()))
    assert docs.count() > 0
