"""The stored index: only touched buckets are written, readers see whole versions, refresh equals the full job."""

import random

import pytest
from pyspark.sql import functions as F

from chartdex.operators import tables
from chartdex.plans import index_refresh, views
from chartdex.plans.index_job import patient_list_index
from chartdex.sources.bucket_index import BucketIndex


@pytest.fixture()
def index(spark, tmp_path):
    rows = spark.range(5000).select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("value"))
    return BucketIndex.create(str(tmp_path / "index"), rows, "id", 50)


def content(index):
    return {r["id"]: r["value"] for r in index.read().collect()}


def test_an_upsert_of_few_ids_writes_their_buckets_only(spark, index):
    before = dict(index.folders)
    changes = spark.createDataFrame([(7, "new", 1), (7, "newer", 2), (9999, "added", 1)], "id long, value string, n int")
    touched = index.apply(lambda current, c: tables.upsert_by_id(current, c, ["n"]), changes)
    assert len(touched) <= 2
    assert {b for b in before if index.folders[b] != before[b]} == touched
    want = {i: f"v{i}" for i in range(5000)} | {7: "newer", 9999: "added"}
    assert content(index) == want
    assert content(BucketIndex(spark, index.path)) == want


def test_only_touched_buckets_are_read(spark, index):
    keys = spark.createDataFrame([(3,), (4,)], "id long")
    read = index.read_keys(keys)
    assert {r["id"] for r in read.collect()} == {3, 4}
    assert len(read.inputFiles()) <= 2 < len(index.read().inputFiles())


def test_a_failed_change_leaves_the_old_version(spark, index):
    changes = spark.createDataFrame([(7, "new")], "id long, value string")

    def failing(current, c):
        bad = F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("value"))
        return current.withColumn("value", bad.cast("string"))

    with pytest.raises(Exception, match="no"):
        index.apply(failing, changes)
    reopened = BucketIndex(spark, index.path)
    assert reopened.version == 1 and content(reopened)[7] == "v7"
    reopened.apply(lambda current, c: tables.partial_update(current, c), changes)
    assert content(BucketIndex(spark, index.path))[7] == "new"


def test_the_second_of_two_changes_at_once_is_refused(spark, index):
    other = BucketIndex(spark, index.path)
    changes = spark.createDataFrame([(7, "new")], "id long, value string")
    index.apply(tables.partial_update, changes)
    with pytest.raises(RuntimeError, match="another change"):
        other.apply(tables.partial_update, changes)
    assert content(BucketIndex(spark, index.path))[7] == "new"


def test_old_versions_stay_readable_and_all_rows_can_go(spark, index):
    old = BucketIndex(spark, index.path)
    index.apply(lambda current, keys: tables.delete_by_key(current, keys, "id"), index.read().select("id"))
    assert content(BucketIndex(spark, index.path)) == {} and len(content(old)) == 5000
    assert index.apply(tables.partial_update, index.read()) == set()
    index.apply(tables.partial_update, spark.createDataFrame([(1, "back")], "id long, value string"))
    assert content(index) == {1: "back"}


VISIT = "rowkey string, OID string, GLOBLE_ID string, IN_PATIENT_ID string, VISIT_ID string, VISIT_TYPE_CODE string, EID string"
FIELDS = ["EID", "IN_PATIENT_ID", "OUT_PATIENT_ID", "INP_NO", "OUTP_NO", "PERSON_NAME", "SEX_CODE", "SEX_NAME"]
FIELDS += ["ID_CARD_NO", "HOME_PHONE", "VISIT_TYPE_CODE", "VISIT_TYPE_NAME", "DATE_OF_BIRTH"]
MASTER = "rowkey string, " + ", ".join(f"{f} string" for f in FIELDS)


def random_visit(r, n):
    pid = f"{r.randrange(12):05d}"
    return (f"v{n}", views.OID, "G", pid, str(r.randrange(50)), r.choice(["01", "02", "03"]), "E")


def random_master(r, n):
    pid, code = f"{r.randrange(12):05d}", r.choice(["01", "02"])
    # numbers are shared between patients, so that documents of several lookup keys have one id
    cells = {"IN_PATIENT_ID": r.choice([pid, "00001", None]), "OUT_PATIENT_ID": r.choice([pid, "00002"]), "VISIT_TYPE_CODE": code}
    key = f"{pid[-4:][::-1]}|{views.OID}|{pid}|{code}|{n}"
    return (key, *[cells.get(f, f"{f}{r.randrange(3)}") for f in FIELDS])


@pytest.mark.parametrize("seed", range(4))
def test_refresh_equals_the_full_job(spark, seed):
    r = random.Random(seed)
    visits = {n: random_visit(r, n) for n in range(60)}
    masters = {n: random_master(r, n) for n in range(25)}
    new_visits, new_masters = dict(visits), dict(masters)
    for table, make, size in ((new_visits, random_visit, 60), (new_masters, random_master, 25)):
        for n in r.sample(range(size), 4):
            del table[n]
        for n in [*r.sample(sorted(table), 3), *range(size, size + 3)]:
            table[n] = make(r, n)

    def changed(old, new, schema):
        rows = [t[n] for t, u in ((old, new), (new, old)) for n in t if t[n] != u.get(n)]
        return spark.createDataFrame(rows, schema)

    def frame(rows, schema):
        return spark.createDataFrame(list(rows.values()), schema)

    before = patient_list_index(frame(visits, VISIT), frame(masters, MASTER), views.OID)
    after = frame(new_visits, VISIT), frame(new_masters, MASTER)
    changes = changed(visits, new_visits, VISIT), changed(masters, new_masters, MASTER)
    want = sorted(patient_list_index(*after, views.OID).collect(), key=str)
    got = index_refresh.refreshed_index(before, *after, *changes, views.OID)
    assert sorted(got.select(*patient_list_index(*after, views.OID).columns).collect(), key=str) == want
    assert want and sorted(before.collect(), key=str) != want
    ids = index_refresh.touched_ids(after[1], *changes, views.OID)
    assert 0 < ids.count()
    nothing = [t.where("false") for t in changes]
    assert index_refresh.touched_ids(after[1], *nothing, views.OID).count() == 0
