"""Code systems: visit types, identifier kinds, province prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartdex.functions.blank import as_column

# Visit type codes and names.
OUTPATIENT_CODE, INPATIENT_CODE, CHECKUP_CODE, OTHER_CODE = "01", "02", "03", "09"
VISIT_TYPES = {
    OUTPATIENT_CODE: "OUTPV",
    INPATIENT_CODE: "INPV",
    CHECKUP_CODE: "PHY",
    OTHER_CODE: "OTHER",
}
VISIT_TYPE_COLUMN = "VISIT_TYPE_CODE"

# Columns that may hold an identifier of a kind, in order of preference.
IDENTIFIER_FIELDS = {
    "PATIENT_IDENTIFIER": ["IN_PATIENT_ID", "OUT_PATIENT_ID", "PATIENT_ID", "PATIENT_IDENTIFIER"],
    "HEALTH_CARD_NO": ["HEALTH_CARD_NO"],
    "CASE_NO": ["CASE_NO"],
    "HOSPTIAL_NO": ["INP_NO", "OUTP_NO"],
}

# First two digits of a mainland identity card number.
PROVINCES = {
    "11": "北京", "12": "天津", "13": "河北", "14": "山西", "15": "内蒙古",
    "21": "辽宁", "22": "吉林", "23": "黑龙江",
    "31": "上海", "32": "江苏", "33": "浙江", "34": "安徽", "35": "福建", "36": "江西", "37": "山东",
    "41": "河南", "42": "湖北", "43": "湖南", "44": "广东", "45": "广西", "46": "海南",
    "50": "重庆", "51": "四川", "52": "贵州", "53": "云南", "54": "西藏",
    "61": "陕西", "62": "甘肃", "63": "青海", "64": "宁夏", "65": "新疆",
}


def identifier_fields(kind: str) -> list[str] | None:
    return IDENTIFIER_FIELDS.get(kind)


def _translate(c: Column, pairs: dict[str, str]) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for key, value in pairs.items():
        out = out.when(c == F.lit(key), F.lit(value))
    return out


def visit_type_by_code(code) -> Column:
    """Name of a visit type code; anything unknown, null included, is OTHER."""
    return F.coalesce(_translate(as_column(code), VISIT_TYPES), F.lit(VISIT_TYPES[OTHER_CODE]))


def visit_code_by_type(name) -> Column:
    """Code of a visit type name; null for an unknown name."""
    return _translate(as_column(name), {v: k for k, v in VISIT_TYPES.items()})


def visit_type_plan(df: DataFrame, field: str, only_that_type: bool = False, out: str = "VISIT_TYPE") -> DataFrame:
    """Give every row its visit type in the way a source calls for.

    ``field='VISIT_TYPE'`` reads the code column. ``'INPV'`` or ``'OUTPV'`` says
    that the source holds one type: the type is a constant, the code column is
    only read to keep that type's rows when ``only_that_type`` is set. Any other
    field adds no type, and keeps every row.
    """
    if field == "VISIT_TYPE":
        return df.withColumn(out, visit_type_by_code(VISIT_TYPE_COLUMN))
    single = {VISIT_TYPES[c]: c for c in (OUTPATIENT_CODE, INPATIENT_CODE)}
    if field not in single:
        return df.withColumn(out, F.lit(None).cast("string"))
    kept = df.where(F.col(VISIT_TYPE_COLUMN) == single[field]) if only_that_type else df
    return kept.withColumn(out, F.lit(field))
