"""Cells, key/value pairs and keyed records out of wide rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartdex.functions.blank import as_column, first_nonempty, none_blank, not_blank
from chartdex.functions.codes import identifier_fields

ROWKEY = "rowkey"


def cell_value(df: DataFrame, field: str | None) -> Column:
    """Text of a cell; null for a blank or absent column name."""
    if field is None or not field.strip() or field not in df.columns:
        return F.lit(None).cast("string")
    return F.col(field).cast("string")


def identifier_value(df: DataFrame, kind: str) -> Column:
    """First non-empty identifier of a kind among the columns that may hold it."""
    fields = identifier_fields(kind)
    if fields is None:
        return F.lit(None).cast("string")
    return first_nonempty(*[cell_value(df, f) for f in fields])


def to_kv(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) pairs as text; rows where either is blank are dropped."""
    pairs = df.select(cell_value(df, key).alias("key"), cell_value(df, value).alias("value"))
    return pairs.where(none_blank("key", "value"))


def group_first(pairs: DataFrame, order: str | None = None) -> DataFrame:
    """One value per key: the first by ``order``, else the smallest.

    Aggregates on the map side first, so a frequent key costs one row per task.
    """
    chosen = F.min("value") if order is None else F.min(F.struct(order, "value"))["value"]
    return pairs.where(not_blank("value")).groupBy("key").agg(chosen.alias("value"))


def to_kv_dedup(df: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    if order is None:
        return group_first(to_kv(df, key, value))
    pairs = df.select(cell_value(df, key).alias("key"), cell_value(df, value).alias("value"), F.col(order).alias("__order"))
    return group_first(pairs.where(none_blank("key", "value")), "__order")


def to_keyed_map(df: DataFrame, *columns: str, rowkey: str = ROWKEY) -> DataFrame:
    """(rowkey, record): the named cells plus the row key as a map."""
    key = F.col(rowkey).cast("string")
    cells = {"rowkey": key} | {c: cell_value(df, c) for c in columns}
    entries = [e for name, cell in cells.items() for e in (F.lit(name), cell)]
    return df.select(key.alias("key"), F.create_map(*entries).alias("record"))


def to_renamed_map(df: DataFrame, mappings: dict[str, str], rowkey: str = ROWKEY) -> DataFrame:
    """(patient identifier, rowkey, renamed cells) with ``mappings`` from new name to column.

    The column list is fixed, so the record stays as columns; nulls, a null key
    included, are kept.
    """
    cells = [cell_value(df, column).alias(name) for name, column in mappings.items()]
    return df.select(
        identifier_value(df, "PATIENT_IDENTIFIER").alias("key"),
        F.col(rowkey).cast("string").alias("rowkey"),
        *cells,
    )


def put_to_map(entries) -> Column:
    """Keep the map entries whose key and value are not blank."""
    return F.map_filter(as_column(entries), lambda k, v: none_blank(k, v))


def put_field_to_map(entries) -> Column:
    """Keep the map entries whose value is not null; blank values stay."""
    return F.map_filter(as_column(entries), lambda k, v: v.isNotNull())


def fields_to_map(df: DataFrame, mappings: dict[str, str], blanks: bool = True) -> Column:
    """Cells of a row as a map from save name to text; its size is the number of cells taken.

    Null cells are left out, without ``blanks`` blank cells too, and a blank save
    name takes nothing.
    """
    entries = []
    for name, column in mappings.items():
        if name.strip():
            entries += [F.lit(name), cell_value(df, column)]
    record = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    return put_field_to_map(record) if blanks else put_to_map(record)


def copy_nonblank(df: DataFrame, field: str, save_name: str | None) -> DataFrame:
    """Add a cell under a new name where it is not blank; a blank name adds nothing."""
    if save_name is None or not save_name.strip():
        return df
    cell = cell_value(df, field)
    return df.withColumn(save_name, F.when(not_blank(cell), cell))
