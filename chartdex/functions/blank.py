"""Null, empty and blank handling.

*Blank* means null, empty, or nothing but whitespace in the Unicode-aware Java
sense, so an ideographic space is blank but a no-break space is not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value) -> Column:
    """Take a column name or a column."""
    return value if isinstance(value, Column) else F.col(value)


def is_blank(value) -> Column:
    c = as_column(value)
    return c.isNull() | c.rlike(r"\A\p{javaWhitespace}*\z")


def not_blank(value) -> Column:
    return ~is_blank(value)


def none_blank(*values) -> Column:
    return reduce(lambda a, b: a & b, [not_blank(v) for v in values])


def first_nonempty(*values) -> Column:
    """First value that is neither null nor ''; whitespace counts as a value."""
    return F.coalesce(*[F.nullif(as_column(v).cast("string"), F.lit("")) for v in values])


def obj_to_str(value, default: str = "", replace: str | None = None) -> Column:
    """Text of a value, null becoming ``default``.

    With ``replace`` given, both null and a value equal to ``default`` become
    ``replace`` instead.
    """
    text = as_column(value).cast("string")
    if replace is None:
        return F.coalesce(text, F.lit(default))
    return F.when(text.isNull() | (text == F.lit(default)), F.lit(replace)).otherwise(text)


def fill_replace(old, value, replace: str | None, update: bool) -> Column:
    """New content of a cell that may be filled, kept or overwritten.

    Writing is allowed when the cell is absent, holds the placeholder
    ``replace``, or ``update`` is set. A blank ``value`` writes the placeholder,
    or nothing where there is none.
    """
    old, value = as_column(old), as_column(value)
    writable = F.lit(True) if update else old.isNull()
    if replace is not None:
        writable = writable | (old == F.lit(replace))
    placeholder = old if replace is None else F.lit(replace)
    return F.when(writable, F.when(is_blank(value), placeholder).otherwise(value)).otherwise(old)
