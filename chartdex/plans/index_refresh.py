"""Bringing the patient list index up to date from what changed, without recomputing the rest.

A document is made of the visits and master rows of the lookup keys that lead to its id.
From the changed rows follow the touched lookup keys, from those the touched ids, and from
these all lookup keys that feed them; only these are looked up again. A touched id that
has no document any more leaves the index.

Changed rows are given in both versions: an inserted row as it is, a deleted row as it was,
an updated row as it was and as it is. ``visits`` and ``patients`` are the tables after the
change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartdex.operators.joins import matching
from chartdex.operators.lookups import DOCUMENT_FIELDS, LOOKUP_KEY, SALT_RANGE, master_documents, routed_visits
from chartdex.plans.index_job import VISIT_COLUMNS, index_documents
from chartdex.sources.bucket_index import BucketIndex

_FOUND = "__found"


def touched_ids(
    patients: DataFrame,
    visit_changes: DataFrame,
    patient_changes: DataFrame,
    oid: str,
    salt_range: tuple[int, int] = SALT_RANGE,
) -> DataFrame:
    """The ids whose documents may differ after the change."""
    keys = routed_visits(visit_changes, oid, salt_range=salt_range).select(LOOKUP_KEY).distinct()
    by_visit = matching(master_documents(patients), keys, LOOKUP_KEY).select("id")
    # of changed masters the old version names the document that may go, the new one that comes
    return by_visit.union(master_documents(patient_changes).select("id")).distinct()


def documents_of(
    visits: DataFrame, patients: DataFrame, ids: DataFrame, oid: str, salt_range: tuple[int, int] = SALT_RANGE
) -> DataFrame:
    """The documents of some ids; an id without a source has none."""
    masters = matching(master_documents(patients), ids, "id")
    keys = masters.select(LOOKUP_KEY).distinct()
    wanted = matching(routed_visits(visits, oid, salt_range=salt_range), keys, LOOKUP_KEY).select(*visits.columns)
    return index_documents(wanted, masters, oid, salt_range)


def refresh_changes(
    visits: DataFrame,
    patients: DataFrame,
    visit_changes: DataFrame,
    patient_changes: DataFrame,
    oid: str,
    salt_range: tuple[int, int] = SALT_RANGE,
) -> DataFrame:
    """Touched ids with their new documents; where there is none any more, the other fields are null."""
    columns = [c for c in VISIT_COLUMNS if c in visits.columns]
    ids = touched_ids(patients, visit_changes, patient_changes, oid, salt_range)
    fresh = documents_of(visits.select(*columns), patients, ids, oid, salt_range)
    return ids.join(fresh.withColumn(_FOUND, F.lit(True)), "id", "left")


def with_changes(index: DataFrame, changes: DataFrame) -> DataFrame:
    """An index after ``refresh_changes``."""
    found = changes.where(F.col(_FOUND)).select(*DOCUMENT_FIELDS)
    return matching(index.select(*DOCUMENT_FIELDS), changes, "id", present=False).unionByName(found)


def refreshed_index(
    index: DataFrame,
    visits: DataFrame,
    patients: DataFrame,
    visit_changes: DataFrame,
    patient_changes: DataFrame,
    oid: str,
    salt_range: tuple[int, int] = SALT_RANGE,
) -> DataFrame:
    """The whole index after the change; equal to the full job over the new tables."""
    return with_changes(index, refresh_changes(visits, patients, visit_changes, patient_changes, oid, salt_range))


def refresh_bucket_index(
    index: BucketIndex,
    visits: DataFrame,
    patients: DataFrame,
    visit_changes: DataFrame,
    patient_changes: DataFrame,
    oid: str,
    salt_range: tuple[int, int] = SALT_RANGE,
) -> set[int]:
    """Refresh a stored index; only the buckets of touched ids are read and written. Returns them."""
    return index.apply(with_changes, refresh_changes(visits, patients, visit_changes, patient_changes, oid, salt_range))
