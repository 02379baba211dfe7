"""Properties of the physical plans that matter at scale."""

import pytest

from chartdex.catalog import load

QUERIES, _ = load()


@pytest.fixture(autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_nested_loops(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.mark.parametrize(
    "name, filters",
    [
        ("scan_filtered", ["EqualTo(o_orderstatus,F)", "GreaterThanOrEqual(o_totalprice,200000.0)"]),
        ("scan_filter_list", ["Or(EqualTo(o_orderpriority,1-URGENT),EqualTo(o_orderpriority,2-HIGH))"]),
        ("scan_incremental", ["GreaterThanOrEqual(o_orderdate,2000-01-01T00:00)"]),
        ("filter_typed", ["GreaterThan(p_size,30)"]),
        ("filter_typed_date", ["GreaterThanOrEqual(o_orderdate,1999-06-15T00:00)"]),
        ("filter_sw", ["StringStartsWith(p_name,red)"]),
    ],
)
def test_filters_reach_the_scan(spark, sf_dir, name, filters):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    for f in filters:
        assert any(f in line for line in pushed), plan


def test_scans_read_only_their_columns(spark, sf_dir):
    plan = plan_of(QUERIES["scan_incremental"](spark, sf_dir))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize(
    "name", ["patient_list_index", "patient_list_index_salt", "lookup_doctors", "append_idempotent", "append_idempotent_null", "upsert_by_id"]
)
def test_first_rows_are_ranked_on_the_map_side(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "SortAggregate" not in plan
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_index_job_scans_once_and_shuffles_visits_once(spark, sf_dir):
    lines = plan_of(QUERIES["patient_list_index"](spark, sf_dir)).splitlines()
    assert sum("FileScan" in line for line in lines) == 2
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "o_orderkey" in line)
    join = max(i for i in range(scan) if "Join" in lines[i])
    between = [line for line in lines[join:scan] if "Exchange hashpartitioning" in line]
    # one by patient and type, one by lookup key for what is left
    assert sum("IN_PATIENT_ID" in line for line in between) == 1
    limit = max(i for i in range(scan) if "WindowGroupLimit" in lines[i])
    assert limit > max(i for i in range(scan) if "Exchange" in lines[i])


def test_patient_ids_are_checked_once_a_row(spark, sf_dir):
    plan = plan_of(QUERIES["lookup_inpatient"](spark, sf_dir))
    filters = [line for line in plan.splitlines() if "Filter (" in line or "Project [" in line]
    assert sum(line.count("raise_error") for line in filters) == 1
