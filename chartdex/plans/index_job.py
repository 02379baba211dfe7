"""The patient list index: one document per patient number and visit type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from chartdex.functions.keys import SEPARATOR, in_prefix_range, rowkey_prefix
from chartdex.operators.filters import FilterSpec
from chartdex.operators.joins import first_by_key
from chartdex.operators.lookups import DOCUMENT_FIELDS, LOOKUP_KEY, SALT_RANGE, master_documents, routed_visits
from chartdex.operators.tables import upsert_by_id
from chartdex.sources.scans import scan_filtered
from chartdex.sources.sinks import BATCH_SIZE, write_batched

# Columns read from the visit list.
VISIT_COLUMNS = ["OID", "GLOBLE_ID", "IN_PATIENT_ID", "VISIT_ID", "VISIT_TYPE_CODE", "EID"]


def latest_visits(visits: DataFrame, oid: str, salt_range: tuple[int, int] = SALT_RANGE) -> DataFrame:
    """The last visit, by its number, per master lookup key.

    Only the visit number of a visit reaches the document, and the document of the
    last visit wins, so earlier visits go before the join: a task hands on one visit per
    patient and type, and visits are shuffled once.
    """
    number = F.col("VISIT_ID").try_cast("bigint").alias("number")
    visit = ["IN_PATIENT_ID", "VISIT_TYPE_CODE"]
    last = first_by_key(visits.select(*visit, "VISIT_ID", number), visit, [F.desc("number"), F.desc("VISIT_ID")])
    return routed_visits(last, oid, salt_range=salt_range).select(LOOKUP_KEY, "number", "VISIT_ID")


def index_documents(
    visits: DataFrame, masters: DataFrame, oid: str, salt_range: tuple[int, int] = SALT_RANGE
) -> DataFrame:
    """Index documents of visits over master documents, fresh or stored by ``save_masters``.

    Where several documents share an id, that of the latest visit wins, then the
    smallest EID and row key.
    """
    documents = latest_visits(visits, oid, salt_range).join(masters, LOOKUP_KEY)
    latest = [F.desc("number"), F.asc("EID"), F.asc("master_rowkey"), *[F.asc(f) for f in DOCUMENT_FIELDS if f not in ("id", "EID")]]
    return first_by_key(documents, ["id"], latest).select(*DOCUMENT_FIELDS)


def patient_list_index(
    visits: DataFrame,
    patients: DataFrame,
    oid: str,
    patient_id: str | None = None,
    salt_range: tuple[int, int] = SALT_RANGE,
) -> DataFrame:
    """Index documents of all visits, or of one patient's.

    Visits of a routed type are joined to the master rows of their patient and
    type; a visit of another type or without a master row gives no document.
    """
    one: list[FilterSpec] = []
    if patient_id and patient_id.strip():
        one = [FilterSpec("IN_PATIENT_ID", "=", patient_id)]
        # a constant key range, so a table sorted by row key is read only where the patient is
        prefix = F.concat(rowkey_prefix(F.lit(patient_id), oid, *salt_range), F.lit(SEPARATOR))
        patients = patients.where(in_prefix_range("rowkey", prefix))
    wanted = scan_filtered(visits, one, *VISIT_COLUMNS)
    return index_documents(wanted, master_documents(patients), oid, salt_range)


def save_masters(patients: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Store master documents bucketed and sorted by lookup key.

    A job over the stored table joins without shuffling the master side again.
    """
    writer = master_documents(patients).write.mode("errorifexists").bucketBy(buckets, LOOKUP_KEY).sortBy(LOOKUP_KEY)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def run_index_job(
    visits: DataFrame,
    patients: DataFrame,
    oid: str,
    flush: Callable[[list[Row]], None],
    patient_id: str | None = None,
    batch_size: int = BATCH_SIZE,
    salt_range: tuple[int, int] = SALT_RANGE,
) -> None:
    """Build the documents and hand them to an index in batches."""
    write_batched(patient_list_index(visits, patients, oid, patient_id, salt_range), flush, batch_size)


def refresh_index(index: DataFrame, documents: DataFrame) -> DataFrame:
    """The index after a bulk upsert of job output; of several runs the latest visit counts, by its number."""
    numbered = documents.withColumn("__number", F.col("VISIT_ID").try_cast("bigint"))
    return upsert_by_id(index, numbered, order=["__number", "VISIT_ID"])
