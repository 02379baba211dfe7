"""Views that shape the driver tables like the tables the operators are made for.

Every view keeps the size of the tables it is derived from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OID = "1.2.156"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _padded(c: str, width: int = 8) -> Column:
    return F.lpad(_text(c), width, "0")


def _keyed(pid: Column, *rest: Column) -> Column:
    parts = [F.reverse(F.right(pid, F.lit(4))), F.lit(OID), pid, *rest]
    return F.concat_ws("|", *parts)


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient master: some types missing, every fiftieth customer with two rows per type."""
    key, pid = F.col("c_custkey"), _padded("c_custkey")
    types = F.filter(F.array(F.lit("01"), F.lit("02")), lambda c: ~(((c == "01") & (key % 10 == 0)) | ((c == "02") & (key % 7 == 0))))
    rows = F.when(key % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    code = F.col("code")
    return (
        table(spark, sf_dir, "customer")
        .withColumn("code", F.explode(types))
        .withColumn("seq", F.explode(rows))
        .select(
            _keyed(pid, code, _text("seq")).alias("rowkey"),
            F.concat(F.lit("E"), pid).alias("EID"),
            pid.alias("IN_PATIENT_ID"),
            F.concat(F.lit("O"), pid).alias("OUT_PATIENT_ID"),
            F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("IN"), pid)).alias("INP_NO"),
            F.concat(F.lit("OP"), pid).alias("OUTP_NO"),
            F.col("c_name").alias("PERSON_NAME"),
            (key % 2 + 1).cast("string").alias("SEX_CODE"),
            F.when(key % 2 == 0, "M").otherwise("F").alias("SEX_NAME"),
            F.concat((key % 56 + 11).cast("string"), _padded("c_custkey", 16)).alias("ID_CARD_NO"),
            F.when(key % 5 != 0, F.concat(F.lit("555"), pid)).alias("HOME_PHONE"),
            code.alias("VISIT_TYPE_CODE"),
            F.when(code == "01", "OUTPV").otherwise("INPV").alias("VISIT_TYPE_NAME"),
            F.concat_ws(
                "-",
                (key % 85 + 1940).cast("string"),
                F.lpad((key % 12 + 1).cast("string"), 2, "0"),
                F.lpad((key % 28 + 1).cast("string"), 2, "0"),
            ).alias("DATE_OF_BIRTH"),
        )
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit list: one row per order."""
    pid = _padded("o_custkey")
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        _keyed(pid, _text("o_orderkey")).alias("rowkey"),
        F.lit(OID).alias("OID"),
        F.concat(F.lit("G"), pid).alias("GLOBLE_ID"),
        pid.alias("IN_PATIENT_ID"),
        _text("o_orderkey").alias("VISIT_ID"),
        F.when(status == "F", "01").when(status == "O", "02").otherwise("03").alias("VISIT_TYPE_CODE"),
        F.concat(F.lit("E"), pid).alias("EID"),
    )


def visit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit records: one row per line item."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    supplier = F.col("l_suppkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        _keyed(
            _padded("o_custkey"),
            _text("l_orderkey"),
            _text("l_linenumber"),
            _text("l_partkey"),
            _text("l_suppkey"),
            F.col("l_quantity").cast("int").cast("string"),
        ).alias("rowkey"),
        _text("l_orderkey").alias("VISIT_ID"),
        F.concat(F.lit("D"), supplier.cast("string")).alias("REQUEST_DOCTOR"),
        F.concat(F.lit("P"), (supplier % 10).cast("string")).alias("PARENT_DOCTOR"),
        F.concat(F.lit("S"), (supplier % 3).cast("string")).alias("SUPER_DOCTOR"),
        F.col("l_returnflag").alias("TMP_HOUSEMAN"),
        F.concat(F.lit("DEPT"), (F.col("l_partkey") % 20).cast("string")).alias("DEPT"),
    )


def adr_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring events: one row per order, with a stored key."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    status = F.col("o_orderstatus")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        (F.col("o_orderkey") + 1).alias("pk_event_id"),
        F.concat(F.lit("EV-"), "o_orderpriority").alias("event_name"),
        _padded("o_custkey").alias("patient_id"),
        _text("o_orderkey").alias("visit_id"),
        F.when(status == "F", "OUTPV").when(status == "O", "INPV").otherwise("PHY").alias("visit_type"),
        F.col("c_name").alias("person_name"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("sex"),
        _text("c_nationkey").alias("dept_code"),
        F.col("c_mktsegment").alias("dept_name"),
        _text("o_orderdate").alias("adt_time"),
        F.col("o_orderpriority").alias("diag"),
        _text("o_orderdate").alias("monitor_time"),
        status.alias("status"),
    )


def adr_labinfo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lab rows of the events: one row per line item."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        (F.col("l_orderkey") + 1).alias("pk_event_id"),
        F.concat(F.lit("N"), _text("l_linenumber")).alias("order_no"),
        _text("l_partkey").alias("order_item_code"),
        F.col("p_name").alias("order_item_name"),
        _text("l_suppkey").alias("lab_sub_item_code"),
        F.col("p_type").alias("lab_sub_item_name"),
        F.col("l_quantity").cast("int").cast("string").alias("lab_result_value"),
        F.col("l_returnflag").alias("lab_result_unit"),
    )


def adr_drug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drug rows of the events: one row per line item."""
    lines, parts, orders = (table(spark, sf_dir, t) for t in ("lineitem", "part", "orders"))
    started, ended = _text("o_orderdate"), _text("l_shipdate")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            (F.col("l_orderkey") + 1).alias("pk_event_id"),
            F.concat(F.lit("N"), _text("l_linenumber")).alias("order_no"),
            _text("p_partkey").alias("drug_code"),
            F.col("p_type").alias("drug_type"),
            F.col("p_name").alias("drug_name"),
            F.split_part("p_name", F.lit(" "), F.lit(1)).alias("common_name"),
            F.col("p_brand").alias("license_no"),
            F.concat(F.lit("M"), _text("l_suppkey")).alias("manufacturer"),
            F.col("l_linestatus").alias("adr_usage"),
            F.concat(started, F.lit("~"), ended).alias("medication_start_end_time"),
            started.alias("medication_start_time"),
            ended.alias("medication_end_time"),
        )
    )
