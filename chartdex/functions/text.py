"""Numbers in text, lists in text, encodings, JSON and XML."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartdex.functions.blank import as_column, is_blank, not_blank

# Comparison symbols.
SYMBOLS = {
    ">": lambda a, b: a > b,
    "≥": lambda a, b: a >= b,
    "=": lambda a, b: a == b,
    "≤": lambda a, b: a <= b,
    "<": lambda a, b: a < b,
    "≠": lambda a, b: a != b,
}
# Record fields that never reach JSON output.
JSON_EXCLUDED = ["handler", "hibernateLazyInitializer"]
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def is_number(value) -> Column:
    """Does the text parse as a double? ``1e3``, `` 12 ``, ``1d`` and ``NaN`` do."""
    return to_number(value).isNotNull()


def to_number(value) -> Column:
    """The double in a text, or null.

    Only the exact spellings ``NaN`` and ``Infinity`` are numbers, whereas a cast
    would also take ``inf`` and other capitalisations.
    """
    c = as_column(value)
    word = c.rlike(r"(?i)\A[\x00-\x20]*[+-]?(inf|infinity|nan)[\x00-\x20]*\z")
    exact = c.rlike(r"\A[\x00-\x20]*[+-]?(Infinity|NaN)[\x00-\x20]*\z")
    bare = F.regexp_replace(c, r"[\x00-\x20]", "")
    special = F.when(exact & bare.contains("NaN"), F.lit(float("nan"))).when(
        exact, F.when(bare.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    )
    return F.when(word, special).otherwise(c.try_cast("double"))


def compare_values(first, second, symbol) -> Column:
    """Compare two doubles by a symbol column or literal; an unknown or null symbol is false."""
    a, b = as_column(first).cast("double"), as_column(second).cast("double")
    op = symbol if isinstance(symbol, Column) else F.lit(symbol)
    out = F.when(op.isNull(), F.lit(False))
    for sign, test in SYMBOLS.items():
        out = out.when(op == F.lit(sign), test(a, b))
    return out.otherwise(F.lit(False))


def fix_mojibake(value) -> Column:
    """Undo a UTF-8 text that was read as Latin-1; bytes that are no UTF-8 become U+FFFD."""
    c = as_column(value)
    latin = F.regexp_replace(c, r"[^\x{00}-\x{FF}]", "?")
    fixed = F.make_valid_utf8(F.encode(latin, "ISO-8859-1").cast("string"))
    return F.when(is_blank(c), c).otherwise(fixed)


def _literal_pattern(separator: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", separator)


def split_list(value, separator: str) -> Column:
    """Non-blank parts of a text; a text without the separator is its own single part."""
    c = as_column(value)
    parts = F.filter(F.split(c, _literal_pattern(separator)), not_blank)
    return (
        F.when(c == "", F.array().cast("array<string>"))
        .when(c.contains(separator), parts)
        .when(c.isNotNull(), F.array(c))
    )


def split_list_distinct(value, separator: str) -> Column:
    return F.array_distinct(split_list(value, separator))


def split_map(value, item_separator: str, kv_separator: str) -> Column:
    """``k1:v1,k2:v2`` as a map: items without the inner separator are skipped, the last of a repeated key wins."""
    c = as_column(value)
    entries = F.transform(
        F.filter(F.split(c, _literal_pattern(item_separator)), lambda item: item.contains(kv_separator)),
        lambda item, i: F.struct(
            F.split_part(item, F.lit(kv_separator), F.lit(1)).alias("key"),
            i.alias("place"),
            F.split_part(item, F.lit(kv_separator), F.lit(2)).alias("value"),
        ),
    )
    # sorted by key and place, an entry is the last of its key where another key follows
    ordered = F.sort_array(entries)
    followers = F.slice(ordered, F.lit(2), F.greatest(F.size(ordered), F.lit(1)))
    marked = F.zip_with(ordered, followers, lambda e, f: F.when(f.isNull() | (f["key"] != e["key"]), e))
    by_place = F.sort_array(F.transform(F.array_compact(marked), lambda e: F.struct(e["place"], e["key"], e["value"])))
    return F.map_from_entries(F.transform(by_place, lambda e: F.struct(e["key"], e["value"])))


def list_to_string(values, separator: str) -> Column:
    """Join a list; a null element is empty text."""
    return F.array_join(as_column(values), separator, "")


def arr_to_string(values, separator: str) -> Column:
    """Join an array; a null element is the text ``null``."""
    return F.array_join(as_column(values), separator, "null")


def list_distinct(values) -> Column:
    """Distinct elements in the order they were first seen."""
    return F.array_distinct(as_column(values))


def json_to_rows(value, element_schema: str) -> Column:
    """JSON array text as an array of records, to be exploded; null for bad text."""
    return F.from_json(as_column(value), f"array<struct<{element_schema}>>")


def without_fields(value, kind: T.DataType, excluded: Sequence[str] = JSON_EXCLUDED) -> Column:
    """A value of a known type without the excluded fields, or map keys, at every level."""
    c = as_column(value)
    if isinstance(kind, T.StructType):
        kept = [without_fields(c[f.name], f.dataType, excluded).alias(f.name) for f in kind if f.name not in excluded]
        return F.when(c.isNotNull(), F.struct(*kept)) if kept else F.when(c.isNotNull(), F.create_map().cast("map<string,string>"))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: without_fields(x, kind.elementType, excluded))
    if isinstance(kind, T.MapType):
        named = F.map_filter(c, lambda k, _: ~k.cast("string").isin(list(excluded)))
        return F.transform_values(named, lambda _, v: without_fields(v, kind.valueType, excluded))
    return c


def rows_to_json(value, kind: T.DataType | None = None, excluded: Sequence[str] = JSON_EXCLUDED) -> Column:
    """A record, list or map as JSON with its nulls written out; null becomes ``{}``.

    With its type given, the excluded fields are left out at every level.
    """
    if kind is not None:
        value = without_fields(value, kind, excluded)
    options = {"ignoreNullFields": "false", "timestampFormat": JSON_TIMESTAMP_FORMAT, "timestampNTZFormat": JSON_TIMESTAMP_FORMAT}
    return F.coalesce(F.to_json(as_column(value), options), F.lit("{}"))


def record_to_json(*columns: str, excluded: Sequence[str] = JSON_EXCLUDED) -> Column:
    """The named columns of a row as one JSON object, without the excluded fields."""
    return rows_to_json(F.struct(*[c for c in columns if c not in excluded]))


#: Levels of objects and arrays that ``json_to_xml`` follows.
JSON_DEPTH = 12
_ITEM = "item"


def _escaped(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def _element_name(key: Column) -> Column:
    """A key as an XML name: other characters as ``_``, and one more in front where a name may not begin so."""
    name = F.regexp_replace(key, r"[^\p{L}\p{N}_.\-]", "_")
    return F.when(name.rlike(r"^[\p{L}_]"), name).otherwise(F.concat(F.lit("_"), name))


def json_to_xml(value, schema: str | None = None, row_tag: str = "o", depth: int = JSON_DEPTH) -> Column:
    """JSON text as XML text without a declaration; null for bad text.

    With a schema, the record of that schema. Without one, JSON of any shape: an object becomes an element per key, in the order of the keys; an array under a key
    repeats the element of the key, elsewhere its items are called ``item``. A null is an
    element with ``null="true"``; an empty object or array an empty element. Objects and
    arrays nested deeper than ``depth`` fail the query.
    """
    if schema is not None:
        parsed = F.from_json(as_column(value), schema)
        return F.when(F.get_json_object(as_column(value), "$").isNotNull(), F.to_xml(parsed, {"rowTag": row_tag}))
    return _xml_element(F.lit(row_tag), F.try_parse_json(as_column(value)), depth)


def _xml_element(tag: Column, value: Column, depth: int) -> Column:
    items = F.try_variant_get(value, "$", "array<variant>")
    fields = F.try_variant_get(value, "$", "map<string,variant>")

    def named(name: Column, values: Column) -> Column:
        return F.transform(values, lambda x: F.struct(name.alias("tag"), x.alias("value")))

    def of_key(entry: Column) -> Column:
        inner = F.try_variant_get(entry["value"], "$", "array<variant>")
        repeated = F.when(F.size(inner) > 0, inner).otherwise(F.array(entry["value"]))
        return named(_element_name(entry["key"]), repeated)

    children = F.when(fields.isNotNull(), F.flatten(F.transform(F.map_entries(fields), of_key))).otherwise(named(F.lit(_ITEM), items))
    if depth == 0:
        body = F.when(F.size(children) > 0, F.raise_error(F.lit("JSON is nested too deeply for XML")).cast("string")).otherwise("")
    else:
        body = F.array_join(F.transform(children, lambda c: _xml_element(c["tag"], c["value"], depth - 1)), "")
    text = F.when(children.isNotNull(), body).otherwise(_escaped(F.try_variant_get(value, "$", "string")))
    whole = F.concat(F.lit("<"), tag, F.lit(">"), text, F.lit("</"), tag, F.lit(">"))
    nothing = F.concat(F.lit("<"), tag, F.lit(' null="true"/>'))
    return F.when(value.isNull(), F.lit(None)).when(F.is_variant_null(value), nothing).otherwise(whole)


def map_to_xml(entries) -> Column:
    """A map as ``<node><key label="k">v</key>…</node>``; a null value is the text ``null``."""
    labelled = map_to_labels(entries)
    return F.to_xml(F.struct(labelled.alias("key")), {"rowTag": "node"})


def map_to_labels(entries) -> Column:
    """The ``key`` elements of the XML form of a map, for an XML sink or ``map_to_xml``."""
    return F.transform(
        F.map_entries(as_column(entries)),
        lambda e: F.struct(e["key"].alias("_label"), F.coalesce(e["value"], F.lit("null")).alias("_VALUE")),
    )
