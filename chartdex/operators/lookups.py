"""Set-based lookups: master records, visit records, events, code labels.

A lookup by key prefix is an equi-join on the ``salt|oid|id`` part of the row key.
Where a side is aggregated first, the join runs on one packed text key instead of
on the grouping columns: both sides then enter the join straight from a shuffle,
which is what adaptive execution needs to split a frequent key over several tasks.
``salt_range`` names the slice of the patient id that stored row keys are salted with.
A patient id that contains the key separator fails the query, as its key prefix cannot
be told from that of another patient.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartdex.functions.blank import as_column
from chartdex.functions.codes import INPATIENT_CODE, OUTPATIENT_CODE, PROVINCES
from chartdex.functions.keys import SEPARATOR, in_own_prefix_range, prefix_of, rowkey_prefix
from chartdex.operators.joins import first_by_key
from chartdex.operators.numbering import number_within

LOOKUP_KEY, _PART = "lookup_key", "part"
SALT_RANGE = (-4, 0)

# Fields of an index document; outpatient documents leave the type fields out.
DOCUMENT_FIELDS = [
    "id", "EID", "IN_PATIENT_ID", "OUT_PATIENT_ID", "VISIT_ID", "INP_NO", "OUT_NO", "PERSON_NAME",
    "SEX_CODE", "SEX_NAME", "ID_CARD_NO", "HOME_PHONE", "VISIT_TYPE_CODE", "VISIT_TYPE_NAME", "DATE_OF_BIRTH",
]
INPATIENT_ONLY_FIELDS = ["VISIT_TYPE_CODE", "VISIT_TYPE_NAME"]
RENAMED_FIELDS = {"OUT_NO": "OUTP_NO"}
DOCTOR_FIELDS = ["REQUEST_DOCTOR", "PARENT_DOCTOR", "SUPER_DOCTOR", "TMP_HOUSEMAN", "DEPT"]
ROUTED_CODES = [OUTPATIENT_CODE, INPATIENT_CODE]


def _pack(*parts: Column) -> Column:
    columns = []
    for p in parts:
        columns += [F.lit(SEPARATOR), p]
    return F.concat(*columns[1:])


def _patient_prefix(oid: str, salt_range: tuple[int, int]) -> Column:
    """The key prefix of a visit's patient."""
    return rowkey_prefix("IN_PATIENT_ID", oid, *salt_range)


def _checked_patients(visits: DataFrame) -> DataFrame:
    """The visits; a patient id with the key separator fails the query. Checked once a row, as a filter."""
    patient = F.col("IN_PATIENT_ID")
    bad = F.raise_error(F.concat(F.lit("separator in patient id "), patient)).cast("boolean")
    return visits.where(F.when(patient.contains(SEPARATOR), bad).otherwise(True))


def routed_visits(
    visits: DataFrame, oid: str, codes: list[str] = ROUTED_CODES, salt_range: tuple[int, int] = SALT_RANGE
) -> DataFrame:
    """Visits of the given types with the key of their master rows; other types give no document."""
    code = F.col("VISIT_TYPE_CODE")
    return _checked_patients(visits.where(code.isin(codes))).withColumn(LOOKUP_KEY, _pack(_patient_prefix(oid, salt_range), code))


def master_documents(patients: DataFrame, codes: list[str] = ROUTED_CODES) -> DataFrame:
    """Master rows of the given types as documents without a visit, under their lookup key.

    The id is the patient number of the type's own number range plus the type code;
    a row without that number gives no document.
    """
    code, rowkey = F.col("VISIT_TYPE_CODE"), F.col("rowkey")
    inpatient = code == INPATIENT_CODE
    number = F.when(inpatient, F.col("IN_PATIENT_ID")).otherwise(F.col("OUT_PATIENT_ID"))
    fields = []
    for name in DOCUMENT_FIELDS:
        if name in ("id", "VISIT_ID"):
            continue
        cell = F.col(RENAMED_FIELDS.get(name, name))
        fields.append((F.when(inpatient, cell) if name in INPATIENT_ONLY_FIELDS else cell).alias(name))
    return (
        patients.where(code.isin(codes) & number.isNotNull())
        .where(in_own_prefix_range(rowkey))
        .select(
            _pack(prefix_of(rowkey), code).alias(LOOKUP_KEY),
            rowkey.alias("master_rowkey"),
            _pack(number, code).alias("id"),
            *fields,
        )
    )


def lookup_documents(
    visits: DataFrame,
    patients: DataFrame,
    oid: str,
    codes: list[str] = ROUTED_CODES,
    salt_range: tuple[int, int] = SALT_RANGE,
) -> DataFrame:
    """One document per visit and matching master row; the EID is the master row's."""
    keyed = routed_visits(visits, oid, codes, salt_range).select(LOOKUP_KEY, F.col("rowkey").alias("visit_rowkey"), "VISIT_ID")
    found = keyed.join(master_documents(patients, codes), LOOKUP_KEY)
    return found.select("visit_rowkey", "master_rowkey", *DOCUMENT_FIELDS)


def lookup_inpatient(
    visits: DataFrame, patients: DataFrame, oid: str, salt_range: tuple[int, int] = SALT_RANGE
) -> DataFrame:
    return lookup_documents(visits, patients, oid, [INPATIENT_CODE], salt_range)


def lookup_outpatient(
    visits: DataFrame, patients: DataFrame, oid: str, salt_range: tuple[int, int] = SALT_RANGE
) -> DataFrame:
    found = lookup_documents(visits, patients, oid, [OUTPATIENT_CODE], salt_range)
    return found.drop(*INPATIENT_ONLY_FIELDS)


def route_by_type(
    visits: DataFrame, patients: DataFrame, oid: str, salt_range: tuple[int, int] = SALT_RANGE
) -> DataFrame:
    """Documents of both routed types in one pass over visits and patients.

    This is also the main form of a document with several values: one row per visit and
    master, in the order of ``master_rowkey``, however many masters there are.
    """
    return lookup_documents(visits, patients, oid, salt_range=salt_range)


def multi_value_docs(
    visits: DataFrame, patients: DataFrame, oid: str, part_size: int, salt_range: tuple[int, int] = SALT_RANGE
) -> DataFrame:
    """Documents of ``route_by_type`` with their values in lists, in key order.

    Part ``p`` of a visit lists its values ``p * part_size`` to ``(p + 1) * part_size``,
    so the caller bounds the lists and no value is left out.
    """
    fields = [f for f in DOCUMENT_FIELDS if f != "VISIT_ID"]
    values = F.sort_array(F.collect_list(F.struct("master_rowkey", *fields)))
    parted = _in_parts(master_documents(patients), part_size)
    parts = parted.groupBy(LOOKUP_KEY, _PART).agg(values.alias("__values"))
    keyed = routed_visits(visits, oid, salt_range=salt_range).select(LOOKUP_KEY, F.col("rowkey").alias("visit_rowkey"), "VISIT_ID")
    joined = keyed.join(parts, LOOKUP_KEY)
    lists = {f: F.col(f"__values.{f}") for f in fields}
    lists["VISIT_ID"] = F.array_repeat("VISIT_ID", F.size("__values"))
    return joined.select("visit_rowkey", _PART, *[lists[f].alias(f) for f in DOCUMENT_FIELDS])


def _in_parts(masters: DataFrame, part_size: int) -> DataFrame:
    """Give every master document its part, by its position among those of its key."""
    numbered = number_within(masters, [LOOKUP_KEY], [F.col("master_rowkey")], "__no")
    return numbered.withColumn(_PART, F.call_function("div", F.col("__no") - 1, F.lit(part_size))).drop("__no")


def lookup_doctors(
    visits: DataFrame, records: DataFrame, oid: str, salt_range: tuple[int, int] = SALT_RANGE
) -> DataFrame:
    """Add the doctors of the first visit record, by row key, of each visit; null where there is none.

    A task hands on the first record it has of each visit, so a visit with very many
    records is no hot key after the shuffle. First records are ranked by prefix and visit,
    not by the packed key of the join, so that a visit that repeats is split as well.
    """
    keyed = _checked_patients(visits).withColumn(LOOKUP_KEY, _pack(_patient_prefix(oid, salt_range), F.col("VISIT_ID")))
    own = records.where(in_own_prefix_range("rowkey")).select(prefix_of("rowkey").alias("__prefix"), "VISIT_ID", "rowkey", *DOCTOR_FIELDS)
    first = first_by_key(own, ["VISIT_ID", "__prefix"], [F.asc(c) for c in ["rowkey", *DOCTOR_FIELDS]])
    packed = _pack(F.col("__prefix"), F.col("VISIT_ID")).alias(LOOKUP_KEY)
    return keyed.join(first.select(packed, *DOCTOR_FIELDS), LOOKUP_KEY, "left").drop(LOOKUP_KEY)


def event_lab_join(events: DataFrame, labs: DataFrame) -> DataFrame:
    return events.join(labs, "pk_event_id")


def exists_count(keys: DataFrame, events: DataFrame, labs: DataFrame) -> DataFrame:
    """Number of stored event and lab rows per distinct (patient, visit, order) key, 0 where none.

    Counts lab rows per event before joining, so both joins see reduced tables.
    """
    key = ["patient_id", "visit_id", "order_no"]
    per_event = labs.groupBy("pk_event_id", "order_no").count()
    stored = (
        per_event.join(events.select("pk_event_id", "patient_id", "visit_id"), "pk_event_id")
        .groupBy(*key)
        .agg(F.sum("count").alias("cnt"))
    )
    return keys.select(*key).distinct().join(stored, key, "left").select(*key, F.coalesce("cnt", F.lit(0)).alias("cnt"))


def province_by_id(df: DataFrame, id_card: str, out: str = "province") -> DataFrame:
    """Province of an identity card number by its first two digits; null for an unknown prefix."""
    names = F.create_map(*[F.lit(x) for pair in PROVINCES.items() for x in pair])
    return df.withColumn(out, F.try_element_at(names, F.substring(id_card, 1, 2)))


def enum_label(df: DataFrame, code, labels: list[tuple[str, str]], out: str = "label") -> DataFrame:
    """Label of a code from a code list; the last of a repeated code wins, an unknown code gives ''.

    The optimizer decides how to join the list, by its size.
    """
    dimension = df.sparkSession.createDataFrame(list(dict(labels).items()), "__code string, __label string")
    joined = df.join(dimension, as_column(code).cast("string") == F.col("__code"), "left")
    return joined.withColumn(out, F.coalesce("__label", F.lit(""))).drop("__code", "__label")
