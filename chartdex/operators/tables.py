"""Table maintenance as pure functions from a current and a change table to a new table.

Files are never updated in place: write the result to a new location or
partition, then switch readers over. Changes that may repeat a key are reduced to
one row per key first, by an aggregation that combines on the map side, so the
joins below see unique keys on both sides and no key can grow a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartdex.functions.blank import not_blank
from chartdex.operators.joins import first_by_key, join_by, matching
from chartdex.operators.numbering import number_rows

_OLD, _NEW = "__old", "__new"

# Columns of the event table and of its two child tables.
EVENT_COLUMNS = [
    "event_name", "patient_id", "visit_id", "visit_type", "person_name", "sex",
    "dept_code", "dept_name", "adt_time", "diag", "monitor_time", "status",
]
EVENT_KEY = "pk_event_id"
LABINFO_COLUMNS = [
    "pk_event_id", "order_no", "order_item_code", "order_item_name",
    "lab_sub_item_code", "lab_sub_item_name", "lab_result_value", "lab_result_unit",
]
DRUG_COLUMNS = [
    "pk_event_id", "order_no", "drug_code", "drug_type", "drug_name", "common_name", "license_no",
    "manufacturer", "adr_usage", "medication_start_end_time", "medication_start_time", "medication_end_time",
]
DUPLICATE_KEYS = ["patient_id", "visit_id", "order_no"]


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key: the greatest by ``order``, then by the row itself."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return first_by_key(df, keys, [F.desc(c) for c in [*order, *rest]])


def _required(key: str) -> Column:
    """The key column; a row without a key fails the query, as a table of keys cannot hold it."""
    return F.when(F.col(key).isNull(), F.raise_error(F.lit(f"a row has no {key}"))).otherwise(F.col(key)).alias(key)


def upsert_by_id(current: DataFrame, incoming: DataFrame, order: list[str], key: str = "id") -> DataFrame:
    """Insert or replace whole rows; among incoming rows of one key the latest wins."""
    newest = latest_by_key(incoming.withColumn(key, _required(key)), [key], order)
    new = newest.select(key, F.struct(*current.columns).alias(_NEW))
    old = current.select(key, F.struct(*current.columns).alias(_OLD))
    return old.join(new, key, "full_outer").select(F.coalesce(_NEW, _OLD).alias(_NEW)).select(f"{_NEW}.*")


def partial_update(
    current: DataFrame, changes: DataFrame, key: str = "id", order: Sequence[str] = (), touched: str | None = None
) -> DataFrame:
    """Set the columns of the change table for its ids, null included; other columns stay.

    An id that is not stored yet becomes a row with only the set fields. Several changes
    of one id count in the given order, field by field. ``touched`` names an array column
    with the fields that a change sets; without it, each change sets all of them.
    """
    fields = [c for c in changes.columns if c not in (key, touched, *order)]

    def latest(c: str) -> Column:
        change = F.struct(*order, F.col(c).alias("value"))
        return F.max(change if touched is None else F.when(F.array_contains(touched, c), change)).alias(c)

    folded = changes.withColumn(key, _required(key)).groupBy(key).agg(*[latest(c) for c in fields])
    new = folded.select(F.col(key), F.struct(*fields).alias(_NEW))
    old = current.select(F.col(key), F.struct(*[c for c in current.columns if c != key]).alias(_OLD))

    def merged(c: str) -> Column:
        if c not in fields:
            return F.col(f"{_OLD}.{c}").alias(c)
        change = F.col(f"{_NEW}.{c}")
        if c not in current.columns:
            return change["value"].alias(c)
        return F.when(change.isNotNull(), change["value"]).otherwise(F.col(f"{_OLD}.{c}")).alias(c)

    rest = [c for c in current.columns if c != key] + [c for c in fields if c not in current.columns]
    return old.join(new, key, "full_outer").select(key, *[merged(c) for c in rest])


def collapse_cells(changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Per key and column, the latest non-null cell of several puts."""
    cells = [
        F.max(F.when(F.col(c).isNotNull(), F.struct(*order, c)))[c].alias(c)
        for c in changes.columns
        if c != key and c not in order
    ]
    return changes.withColumn(key, _required(key)).groupBy(key).agg(*cells)


def put_cells(current: DataFrame, changes: DataFrame, key: str = "rowkey", order: Sequence[str] = ()) -> DataFrame:
    """Overwrite cells by the non-null cells of the change rows; null leaves the stored cell.

    Of several puts of one key the latest non-null cell counts, in the given order.
    """
    changes = collapse_cells(changes, key, order)
    fields = [c for c in changes.columns if c != key]
    columns = [c for c in current.columns if c != key] + [c for c in fields if c not in current.columns]
    old, new = current.alias("old"), changes.alias("new")

    def merged(c: str) -> Column:
        sources = [F.col(f"new.{c}")] if c in fields else []
        if c in current.columns:
            sources.append(F.col(f"old.{c}"))
        return F.coalesce(*sources).alias(c)

    return old.join(new, key, "full_outer").select(key, *[merged(c) for c in columns])


def nonblank_cells(changes: DataFrame, key: str = "rowkey", order: Sequence[str] = ()) -> DataFrame:
    """Blank cells as null, plus ``cells_written``, the number of cells that remain."""
    fields = [c for c in changes.columns if c != key and c not in order]
    written = sum([not_blank(c).cast("bigint") for c in fields], F.lit(0).cast("bigint"))
    return changes.select(
        key, *order, *[F.when(not_blank(c), F.col(c)).alias(c) for c in fields], written.alias("cells_written")
    )


def put_nonblank(current: DataFrame, changes: DataFrame, key: str = "rowkey", order: Sequence[str] = ()) -> DataFrame:
    """As ``put_cells``, where a blank cell also leaves the stored one."""
    return put_cells(current, nonblank_cells(changes, key, order).drop("cells_written"), key, order)


def delete_by_key(current: DataFrame, keys: DataFrame, key: str = "EID") -> DataFrame:
    return matching(current, keys, key, present=False)


def delete_all(current: DataFrame) -> DataFrame:
    return current.where(F.lit(False))


def append_events(current: DataFrame, new_events: DataFrame, order: list[str]) -> DataFrame:
    """Append events and give each the next key after the greatest stored one.

    ``order`` must be a total order of the new events: it decides their keys.
    """
    return current.unionByName(assign_event_keys(current, new_events, order))


def assign_event_keys(current: DataFrame, new_events: DataFrame, order: list[str]) -> DataFrame:
    """The new events with their generated keys; nulls stay null."""
    last = current.agg(F.coalesce(F.max(EVENT_KEY), F.lit(0))).scalar()
    numbered = number_rows(new_events.select(*EVENT_COLUMNS), [F.col(c) for c in order], EVENT_KEY, last + 1)
    return numbered.select(EVENT_KEY, *EVENT_COLUMNS)


def with_event_keys(new_rows: DataFrame, events: DataFrame, natural_key: list[str]) -> DataFrame:
    """Child rows with the key of their event, stored earlier or new, found by its natural key.

    Two nulls are equal. A row without an event has no key; a natural key that several
    events share fails the query, as it names none of them.
    """
    several = F.raise_error(F.concat(F.lit("several events share "), F.to_json(F.struct(*natural_key))))
    one = F.when(F.min(EVENT_KEY) == F.max(EVENT_KEY), F.min(EVENT_KEY)).otherwise(several.cast("bigint"))
    keys = events.groupBy(*natural_key).agg(one.alias(EVENT_KEY))
    return join_by(new_rows.drop(EVENT_KEY), keys, natural_key, "left", hashed=True)


def without_event(keyed_rows: DataFrame) -> DataFrame:
    """Child rows for which ``with_event_keys`` found no event."""
    return keyed_rows.where(F.col(EVENT_KEY).isNull())


def append_children(current: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Append child rows under the event key they carry; one without a key fails the query.

    Take such rows out by ``without_event`` first where they are to be expected.
    """
    return current.unionByName(new_rows.withColumn(EVENT_KEY, _required(EVENT_KEY)).select(*current.columns))


def append_labinfo(current: DataFrame, new_rows: DataFrame) -> DataFrame:
    return append_children(current.select(*LABINFO_COLUMNS), new_rows)


def append_drugs(current: DataFrame, new_rows: DataFrame) -> DataFrame:
    return append_children(current.select(*DRUG_COLUMNS), new_rows)


def append_idempotent(current: DataFrame, incoming: DataFrame, order: list[str], keys: list[str] = DUPLICATE_KEYS) -> DataFrame:
    """Append only rows whose keys are not stored yet; the first of equal incoming keys stays.

    Two null keys are equal, so a repeated run adds nothing.
    """
    # stored keys go first, as only the rest has to be ordered within its keys
    fresh = join_by(incoming, current.select(*keys).distinct(), keys, "left_anti")
    rest = [c for c in incoming.columns if c not in keys and c not in order]
    first = first_by_key(fresh, keys, [F.asc(c) for c in [*order, *rest]])
    return current.unionByName(first.select(*current.columns))


def update_where(current: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns where the condition holds; all new values see the old row."""
    hit = F.coalesce(condition, F.lit(False))
    return current.select(
        *[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in current.columns]
    )


def delete_where(current: DataFrame, condition: Column) -> DataFrame:
    return current.where(~F.coalesce(condition, F.lit(False)))


def affected_rows(current: DataFrame, condition: Column) -> DataFrame:
    """How many rows an update or delete with this condition touches."""
    return current.agg(F.count_if(condition).alias("affected"))
