"""A small filter vocabulary compiled to columns.

Cells are text, so comparisons are lexicographic by UTF-8 bytes unless a filter
is typed. A row whose cell is missing never passes, also for negative operators.
Filters on text columns carry no cast, so they reach the Parquet scan.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartdex.operators.joins import matching

# Operator names.
COMPARISONS = {
    "=": lambda c, v: c == v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "<>": lambda c, v: c != v,
}
TEXT_OPS = ["like", "nlike", "inlike", "in", "nin", "sw", "ew"]
NULL_OPS = ["isnull", "notnull"]

# Value type names.
VALUE_TYPES = {
    "STRING": "string",
    "INT": "int",
    "LONG": "bigint",
    "DOUBLE": "double",
    "DATE": "timestamp_ntz",
    "BOOL": "boolean",
    "SHORT": "smallint",
    "BIGDECIMAL": "decimal(38,18)",
    "ENUM": "string",
}


_INT_BITS = {"SHORT": 16, "INT": 32, "LONG": 64}


def _check_literal(kind: str, value: object) -> None:
    """Raise where a literal is no value of its type; a comparison with it would drop every row."""
    text = str(value).strip()
    try:
        if kind in _INT_BITS:
            if not -(1 << (_INT_BITS[kind] - 1)) <= int(text) < 1 << (_INT_BITS[kind] - 1):
                raise ValueError("out of range")
        elif kind == "DOUBLE":
            float(text)
        elif kind == "BIGDECIMAL":
            if not Decimal(text).is_finite():
                raise ValueError("not finite")
        elif kind == "BOOL" and text.lower() not in ("true", "false"):
            raise ValueError("neither true nor false")
        elif kind == "DATE" and not isinstance(value, dt.date):
            dt.datetime.fromisoformat(text)
    except (ValueError, InvalidOperation) as e:
        raise ValueError(f"filter value {value!r} is no {kind}") from e


@dataclass(frozen=True)
class FilterSpec:
    """``name op value``; list operators take comma-separated values.

    ``type`` other than STRING or ENUM compares converted values instead of text.
    ``regex`` makes the text operators treat their value as a pattern.
    """

    name: str
    op: str
    value: object = None
    type: str = "STRING"
    regex: bool = False

    def __post_init__(self):
        if self.op not in COMPARISONS and self.op not in TEXT_OPS + NULL_OPS:
            raise ValueError(f"unknown filter operator {self.op!r}")
        if self.type not in VALUE_TYPES:
            raise ValueError(f"unknown filter value type {self.type!r}")
        if self.op in COMPARISONS and VALUE_TYPES[self.type] != "string":
            _check_literal(self.type, self.value)

    def parts(self) -> list[str]:
        """Comma-separated values; empty ones at the end do not count."""
        items = str(self.value).split(",")
        while len(items) > 1 and items[-1] == "":
            items.pop()
        return items

    def column(self, schema: T.StructType | None = None) -> Column:
        """The filter as a column; with the table's schema, typed cells are compared uncast."""
        if self.op in NULL_OPS:
            cell = F.col(self.name)
            return cell.isNull() if self.op == "isnull" else cell.isNotNull()
        if self.op in COMPARISONS:
            if VALUE_TYPES[self.type] == "string":
                return COMPARISONS[self.op](F.col(self.name).cast("string"), F.lit(str(self.value)))
            return self._typed_match(schema)
        return self._text_match(F.col(self.name).cast("string"))

    def _typed_match(self, schema: T.StructType | None) -> Column:
        kind: str | T.DataType = VALUE_TYPES[self.type]
        stored = schema[self.name].dataType if schema is not None and self.name in schema.names else T.StringType()
        cell = F.col(self.name)
        if isinstance(stored, T.StringType):
            cell = cell.try_cast(kind)
        elif isinstance(stored, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            kind = stored
        return COMPARISONS[self.op](cell, F.lit(self.value).try_cast(kind))

    def _text_match(self, cell: Column) -> Column:
        parts = self.parts()

        def any_of(test, pattern: str) -> Column:
            if self.regex:
                return cell.rlike(pattern)
            return reduce(lambda a, b: a | b, [test(p) for p in parts])

        either = "|".join(f"(?:{p})" for p in parts)
        if self.op in ("like", "nlike"):
            found = cell.rlike(str(self.value)) if self.regex else cell.contains(str(self.value))
            return ~found if self.op == "nlike" else found
        if self.op == "inlike":
            return any_of(cell.contains, either)
        if self.op == "sw":
            return any_of(cell.startswith, rf"\A(?:{either})")
        if self.op == "ew":
            return any_of(cell.endswith, rf"(?:{either})\z")
        listed = cell.rlike(rf"\A(?:{either})\z") if self.regex else cell.isin(parts)
        return ~listed if self.op == "nin" else listed


def combine(
    specs: Iterable[FilterSpec], mode: str = "all", missing: str = "drop", schema: T.StructType | None = None
) -> Column:
    """Filters joined by AND (``all``) or OR (``any``); no filter at all passes every row.

    A missing cell counts as failed (``drop``) or passed (``keep``).
    """
    joins = {"all": lambda a, b: a & b, "any": lambda a, b: a | b}
    if mode not in joins:
        raise ValueError("mode must be 'all' or 'any'")
    if missing not in ("drop", "keep"):
        raise ValueError("missing must be 'drop' or 'keep'")
    tests = []
    for s in specs:
        test = s.column(schema)
        if missing == "keep":
            test = test | F.col(s.name).isNull()
        tests.append(test)
    return reduce(joins[mode], tests) if tests else F.lit(True)


def filter_rows(df: DataFrame, *specs: FilterSpec) -> DataFrame:
    return df.where(combine(specs, schema=df.schema))


def in_table(df: DataFrame, column: str, values: DataFrame, negate: bool = False) -> DataFrame:
    """``in`` or ``nin`` against a table of values, for lists too long for a filter text.

    ``values`` has one column. A missing cell is dropped either way.
    """
    listed = values.select(F.col(values.columns[0]).alias(column))
    return matching(df.where(F.col(column).isNotNull()), listed, column, present=not negate)


def add_string_filter(column: str, value: str, op: str, specs: list[FilterSpec]) -> FilterSpec:
    """Append one text comparison to a list of filters."""
    spec = FilterSpec(column, op, value)
    specs.append(spec)
    return spec


def specs_from_text(text: str | None, separator: str) -> list[FilterSpec]:
    """Filters from ``column|op|values`` items joined by ``separator`` (a pattern).

    Items without a value are left out; blank text gives no filter.
    """
    if text is None or not text.strip():
        return []
    fields = [item.split("|") for item in re.split(separator, text) if item]
    return [FilterSpec(f[0], f[1], f[2]) for f in fields if len(f) > 2 and f[2].strip()]
