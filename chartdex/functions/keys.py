"""Salted row keys.

A key starts with ``salt|oid|id``: the salt is a reversed slice of the id, so
ids issued in sequence do not land next to each other in a sorted table. All
parts are joined with ``concat`` so that a null part makes the key null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartdex.functions.blank import as_column, none_blank

# They are part of stored keys.
SEPARATOR = "|"
RANGE_END = "}"
OUT_OF_RANGE_SALT = "zzzz"


def salt(patient_id, start: int = -4, end: int = 0) -> Column:
    """Reversed ``[start, end)`` slice of the id.

    A negative start together with an end <= 0 counts from the end of the id. An
    id too short for the slice gets the out-of-range salt.
    """
    c = as_column(patient_id)
    n = F.length(c)
    if start < 0 and end <= 0:
        fits = (n + start >= 0) & (n + end > 0)
        first, width = n + F.lit(start + 1), end - start
    elif 0 <= start <= end:
        fits = n >= end
        first, width = F.lit(start + 1), end - start
    else:
        fits, first, width = F.lit(False), F.lit(1), 0
    if width < 0:
        fits, width = F.lit(False), 0
    return F.when(fits, F.reverse(F.substr(c, first, F.lit(width)))).when(
        c.isNotNull(), F.lit(OUT_OF_RANGE_SALT)
    )


def rowkey_prefix(patient_id, oid: str, start: int = -4, end: int = 0) -> Column:
    c = as_column(patient_id)
    return F.concat(salt(c, start, end), F.lit(f"{SEPARATOR}{oid}{SEPARATOR}"), c)


def prefix_of(rowkey) -> Column:
    """The ``salt|oid|id`` part of a full row key."""
    return F.substring_index(as_column(rowkey), SEPARATOR, 3)


def in_prefix_range(rowkey, prefix: str | Column) -> Column:
    """Half-open key range ``[prefix, prefix + '}')``, compared by UTF-8 bytes."""
    key, low = as_column(rowkey), prefix if isinstance(prefix, Column) else F.lit(prefix)
    return (key >= low) & (key < F.concat(low, F.lit(RANGE_END)))


def in_own_prefix_range(rowkey) -> Column:
    """Is the key in the range of its own ``salt|oid|id|`` prefix?

    It is when it has a third separator that ends the key or is followed by a
    character below the range end.
    """
    return as_column(rowkey).rlike(r"\A(?:[^|]*\|){3}(?:[\x{00}-\x{7C}]|\z)")


def visit_rowkey_prefix(eid, oid: str) -> Column:
    c = as_column(eid)
    tail = F.when(F.length(c) >= 4, F.reverse(F.right(c, F.lit(4))))
    return F.concat(tail, F.lit(f"{SEPARATOR}{oid}{SEPARATOR}"), c)


def visit_rowkey(patient_id, visit_type, visit_id, eid, oid: str) -> Column:
    """``salt|oid|eid|type|visit|patient``; null when any part is blank."""
    pid, kind, vid, e = (as_column(v) for v in (patient_id, visit_type, visit_id, eid))
    sep = F.lit(SEPARATOR)
    key = F.concat(visit_rowkey_prefix(e, oid), sep, kind, sep, vid, sep, pid)
    return F.when(none_blank(pid, kind, vid, e), key)
