"""Codebook decoding: coded survey answers -> labels, tri-state booleans, numbers.

Codes arrive as doubles.  They are rounded half-to-even before matching, so
1.9 and 2.5 both decode as code 2 (the reference engine's integer cast does
the same; Spark's plain cast would truncate 1.9 to 1).  All builders return
JVM-side ``Column`` expressions (a lookup in a literal map), so decoding runs
inside whole-stage codegen and never leaves the executor JVM.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# The codebooks.  code -> label, in code order.
DIABETES_STATUS = {1: "Diagnosed", 2: "Gestational Only", 3: "No", 4: "Prediabetes"}
YES_NO = {1: True, 2: False}
# Hypertension is coded with reversed polarity: 1 = no, 2 = yes.
REVERSED_YES_NO = {1: False, 2: True}
BMI_CATEGORY = {1: "Underweight", 2: "Normal", 3: "Overweight", 4: "Obese"}
PHYSICAL_ACTIVITY = {
    1: "Met Aerobic Recommendations",
    2: "Insufficiently Active",
    3: "Inactive",
}
SEX = {1: "Male", 2: "Female"}
AGE_GROUP = {
    1: "18-24", 2: "25-29", 3: "30-34", 4: "35-39", 5: "40-44", 6: "45-49",
    7: "50-54", 8: "55-59", 9: "60-64", 10: "65-69", 11: "70-74", 12: "75-79",
    13: "80+",
}
RACE_ETHNICITY = {
    1: "White Non-Hispanic",
    2: "Black Non-Hispanic",
    3: "AI/AN Non-Hispanic",
    4: "Asian Non-Hispanic",
    5: "NHPI Non-Hispanic",
    6: "Other/Multiracial Non-Hispanic",
    7: "Hispanic",
}
RACE_ETHNICITY_COLLAPSED = {
    1: "White Non-Hispanic",
    2: "Black Non-Hispanic",
    3: "Hispanic",
    4: "Other Non-Hispanic",
    5: "Multiracial Non-Hispanic",
}
EDUCATION = {
    1: "Never Attended / Kindergarten",
    2: "Grades 1-8",
    3: "Grades 9-11",
    4: "High School Graduate / GED",
    5: "Some College",
    6: "College Graduate",
}
INCOME = {
    1: "<$10,000",
    2: "$10,000-<$15,000",
    3: "$15,000-<$20,000",
    4: "$20,000-<$25,000",
    5: "$25,000-<$35,000",
    6: "$35,000-<$50,000",
    7: "$50,000-<$75,000",
    8: "$75,000-<$100,000",
    9: "$100,000-<$150,000",
    10: "$150,000-<$200,000",
    11: "≥$200,000",
}
URBAN_RURAL = {1: "Urban", 2: "Rural"}
UNKNOWN = "Unknown"
BMI_MISSING_CODE = 9999


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql_lit(v: Any) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def code_sql(c: str) -> str:
    return f"try_cast(rint({_ident(c)}) AS INT)"


def code_apart_sql(c: str) -> str:
    """``code_sql`` through a lambda.  Spark does not fuse a projection with a
    lambda into the scan's whole-stage method but compiles it in small
    methods; for dozens of lookups that keeps each below the size that the
    JVM compiles to machine code."""
    return f"get(transform(array({_ident(c)}), x -> try_cast(rint(x) AS INT)), 0)"


def as_code(c: Column | str) -> Column:
    """Double code -> INT, rounding half to even; NULL for NULL or out of range."""
    if isinstance(c, str):
        return F.expr(code_sql(c))
    return F.rint(c).try_cast("int")


def codebook_sql(codebook: Mapping[int, Any]) -> str:
    """The codebook as a literal ``map(code, label, ...)`` SQL expression."""
    return "map(" + ", ".join(f"{k}, {_sql_lit(v)}" for k, v in codebook.items()) + ")"


def lookup_sql(code: str, codebook: Mapping[int, Any]) -> str:
    """The label of a code.  Codes of a narrow range index a literal array, a
    bounds test and a load in generated code; others look up a literal map."""
    low, high = min(codebook), max(codebook)
    if high - low > 64:
        return f"element_at({codebook_sql(codebook)}, {code})"
    labels = ", ".join(_sql_lit(codebook.get(k)) for k in range(low, high + 1))
    return f"get(array({labels}), {code} - {low})" if low else f"get(array({labels}), {code})"


def decode_sql(c: str, codebook: Mapping[int, Any], default: Any = None) -> str:
    """SQL text of ``decode`` for a column name (for bulk ``selectExpr``)."""
    if not codebook:
        raise ValueError("empty codebook")
    expr = lookup_sql(code_sql(c), codebook)
    return f"coalesce({expr}, {_sql_lit(default)})" if default is not None else expr


def decode(c: Column | str, codebook: Mapping[int, Any], default: Any = None) -> Column:
    """Look the rounded code up in the codebook; unknown code -> ``default``.

    A literal-map lookup evaluates the code once and compiles to a few lines
    of generated code (a long ``CASE`` chain would repeat the code expression
    per arm and bloat the stage's generated method).  With a non-NULL
    ``default`` it also absorbs NULL codes (``diabetes_status`` and ``sex``
    decode NULL to 'Unknown').  Missing keys give NULL, also under ANSI mode.
    The expression is built as one SQL snippet: one driver->JVM call per
    column instead of one per map entry.
    """
    if not codebook:
        raise ValueError("empty codebook")
    if isinstance(c, str):
        return F.expr(decode_sql(c, codebook, default))
    looked_up = F.element_at(F.expr(codebook_sql(codebook)), as_code(c))
    return F.coalesce(looked_up, F.lit(default)) if default is not None else looked_up


def decode_bool(c: Column | str, reversed_polarity: bool = False) -> Column:
    """Tri-state boolean: 1/2 -> true/false (or false/true), anything else NULL."""
    return decode(c, REVERSED_YES_NO if reversed_polarity else YES_NO)


def decode_bool_sql(c: str, reversed_polarity: bool = False) -> str:
    return decode_sql(c, REVERSED_YES_NO if reversed_polarity else YES_NO)


def sentinel_scaled_sql(c: str, sentinel: int = BMI_MISSING_CODE, scale: float = 100.0, digits: int = 1) -> str:
    col = _ident(c)
    return f"if({code_sql(c)} <=> {sentinel}, CAST(NULL AS DOUBLE), round(CAST({col} AS DOUBLE) / {float(scale)!r}D, {digits}))"


def sentinel_scaled(
    c: Column | str, sentinel: int = BMI_MISSING_CODE, scale: float = 100.0, digits: int = 1
) -> Column:
    """NULL for the sentinel code or NULL, else ``round(c / scale, digits)``."""
    if isinstance(c, str):
        return F.expr(sentinel_scaled_sql(c, sentinel, scale, digits))
    return F.when(~as_code(c).eqNullSafe(F.lit(sentinel)), F.round(c.cast("double") / F.lit(scale), digits))
