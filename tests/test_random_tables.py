"""The index job and table maintenance against plain Python on random small tables."""

import random

import pytest
from pyspark.sql import functions as F

from chartdex.operators import lookups, tables
from chartdex.plans.index_job import patient_list_index

OID = "o"
REST = ["INP_NO", "OUTP_NO", "PERSON_NAME", "SEX_CODE", "SEX_NAME", "ID_CARD_NO", "HOME_PHONE", "DATE_OF_BIRTH"]


def prefix(pid):
    salt = pid[-4:][::-1] if len(pid) >= 4 else "zzzz"
    return f"{salt}|{OID}|{pid}|"


def in_range(key, start):
    return start.encode() <= key.encode() < (start + "}").encode()


def random_tables(seed):
    rng = random.Random(seed)
    pids = ["0001", "0002", "12345", "99", "", "中文0001", "77770001"]
    visits, masters = [], {}
    for i in range(60):
        pid = rng.choice([*pids, None, "unknown1"])
        vid = rng.choice(["1", "2", "10", "007", "x", "", None, str(rng.randint(0, 30))])
        visits.append((f"v{i}", pid, vid, rng.choice(["01", "02", "02", "03", None])))
    for _ in range(25):
        pid = rng.choice(pids)
        key = prefix(pid) + rng.choice(["01|1", "02|1", "02|2", "}", "~z", "", "中", f"{rng.randint(0, 9)}"])
        masters[key] = (
            rng.choice(["E1", "E2", "E3"]), rng.choice([pid, pid, "shared", None]), rng.choice(["O" + pid, "shared", None]), rng.choice(["01", "02", "09", None]),
        )
    return visits, masters


def frames(spark, visits, masters):
    visit_df = spark.createDataFrame(visits, "rowkey string, IN_PATIENT_ID string, VISIT_ID string, VISIT_TYPE_CODE string")
    visit_df = visit_df.select("*", *[F.lit(None).cast("string").alias(c) for c in ("OID", "GLOBLE_ID", "EID")])
    schema = "rowkey string, EID string, IN_PATIENT_ID string, OUT_PATIENT_ID string, VISIT_TYPE_CODE string"
    master_df = spark.createDataFrame([(k, *m) for k, m in masters.items()], schema)
    extra = [F.concat(F.lit(c), "rowkey").alias(c) for c in [*REST, "VISIT_TYPE_NAME"]]
    return visit_df, master_df.select("*", *extra)


def found(visits, masters):
    """(visit, master key, document id) of every lookup that gives a document."""
    for rowkey, pid, vid, code in visits:
        if pid is None or code not in ("01", "02"):
            continue
        for key, (_, inp, outp, master_code) in masters.items():
            number = inp if code == "02" else outp
            if master_code == code and number is not None and in_range(key, prefix(pid)):
                yield rowkey, pid, vid, code, key, f"{number}|{code}"


@pytest.mark.parametrize("seed", range(6))
def test_index_job(spark, seed):
    visits, masters = random_tables(seed)
    visit_df, master_df = frames(spark, visits, masters)

    def rank(vid):
        number = int(vid) if vid is not None and vid.isdigit() else None
        return (number is not None, number or 0, vid is not None, vid or "")

    latest = {}
    for _, pid, vid, code in visits:
        if pid is not None and (pid, code) in latest:
            latest[pid, code] = max(latest[pid, code], vid, key=rank)
        elif pid is not None:
            latest[pid, code] = vid
    best = {}
    for _, pid, _, code, key, doc_id in found(visits, masters):
        vid = latest[pid, code]
        is_number, number, *_ = rank(vid)
        order = (-number if is_number else 2**63, masters[key][0], key.encode())
        if doc_id not in best or order < best[doc_id][0]:
            best[doc_id] = (order, vid, masters[key][0], key, code)
    got = {r["id"]: r for r in patient_list_index(visit_df, master_df, OID).collect()}
    assert set(got) == set(best)
    for doc_id, (_, vid, eid, key, code) in best.items():
        doc = got[doc_id]
        assert (doc["VISIT_ID"], doc["EID"], doc["OUT_NO"], doc["INP_NO"]) == (vid, eid, "OUTP_NO" + key, "INP_NO" + key)
        assert doc["VISIT_TYPE_CODE"] == ("02" if code == "02" else None)


@pytest.mark.parametrize("seed", range(3))
def test_lookups_and_multi_value_documents(spark, seed):
    visits, masters = random_tables(100 + seed)
    visit_df, master_df = frames(spark, visits, masters)
    want = sorted((v, key, doc_id) for v, _, _, _, key, doc_id in found(visits, masters))
    docs = lookups.route_by_type(visit_df, master_df, OID).select("visit_rowkey", "master_rowkey", "id")
    assert sorted(map(tuple, docs.collect())) == want
    lists = {}
    for v, key, doc_id in sorted(want, key=lambda w: (w[0], w[1].encode())):
        lists.setdefault(v, []).append(doc_id)
    got = {}
    parts = lookups.multi_value_docs(visit_df, master_df, OID, part_size=2).orderBy("visit_rowkey", "part").collect()
    for r in parts:
        assert 1 <= len(r["id"]) <= 2
        got.setdefault(r["visit_rowkey"], []).extend(r["id"])
    assert got == lists


@pytest.mark.parametrize("seed", range(3))
def test_table_maintenance(spark, seed):
    rng = random.Random(seed)
    cell = lambda: rng.choice([None, "", " ", "a", "b", "c"])
    current = {k: (cell(), cell()) for k in rng.sample(range(20), 12)}
    puts = [(rng.randrange(20), i, cell(), cell()) for i in range(30)]
    current_df = spark.createDataFrame([(k, *v) for k, v in current.items()], "rowkey int, a string, b string")
    puts_df = spark.createDataFrame(puts, "rowkey int, n int, a string, b string")

    def as_dict(df):
        rows = df.select("rowkey", "a", "b").collect()
        out = {r["rowkey"]: (r["a"], r["b"]) for r in rows}
        assert len(out) == len(rows)
        return out

    last, cells, filled = dict(current), dict(current), dict(current)
    one_per_key = {}
    for key, _, a, b in puts:
        last[key] = (a, b)
        old = cells.get(key, (None, None))
        cells[key] = (old[0] if a is None else a, old[1] if b is None else b)
        one_per_key[key] = (a, b)
    for key, (a, b) in one_per_key.items():
        old = filled.get(key, (None, None))
        filled[key] = tuple(new if new and new.strip() else kept for new, kept in zip((a, b), old, strict=True))

    with_order = current_df.withColumn("n", F.lit(-1)).select("rowkey", "n", "a", "b")
    assert as_dict(tables.upsert_by_id(with_order, puts_df, ["n"], "rowkey")) == last
    collapsed = tables.collapse_cells(puts_df, "rowkey", ["n"])
    assert as_dict(tables.put_cells(current_df, collapsed)) == cells
    latest = tables.latest_by_key(puts_df, ["rowkey"], ["n"]).drop("n")
    assert as_dict(tables.put_nonblank(current_df, latest)) == filled
    assert as_dict(tables.partial_update(current_df, latest, "rowkey")) == last
    gone = {k for k, *_ in puts[:5]}
    keys = spark.createDataFrame([(k,) for k in gone], "rowkey int")
    assert as_dict(tables.delete_by_key(current_df, keys, "rowkey")) == {k: v for k, v in current.items() if k not in gone}
