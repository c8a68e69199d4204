"""Schemas of the survey layers.

The raw layer keeps a fixed allowlist of survey variables.  Source files name
them in upper case, computed variables with a leading underscore; the raw
table uses the normalised name (leading underscores stripped, lower case).
"""

from __future__ import annotations

from pyspark.sql import types as T

# The survey variables kept from every yearly file, in the
# order the raw table stores them.
SOURCE_VARIABLES = [
    "DIABETE4", "PREDIAB2", "INSULIN1",
    "_BMI5", "_BMI5CAT", "_RFHYPE6", "CVDCRHD4", "EXERANY2", "_PAINDX3",
    "FRUIT2", "FRUITJU2", "VEGETAB2",
    "_STATE", "IMONTH", "IYEAR", "SEXVAR", "_AGEG5YR", "_RACE1", "_RACEGR3",
    "EDUCA", "INCOME3", "_URBSTAT",
    "_LLCPWT", "_STSTR", "_PSU",
]


def normalise_name(name: str) -> str:
    """Raw column name rule: strip leading underscores, lower-case."""
    return name.lstrip("_").lower()


RAW_VARIABLES = [normalise_name(v) for v in SOURCE_VARIABLES]

WEIGHT = "llcpwt"
YEAR = "survey_year"
LOADED_AT = "loaded_at"

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), True) for c in RAW_VARIABLES]
    + [
        T.StructField(YEAR, T.IntegerType(), True),
        T.StructField(LOADED_AT, T.StringType(), True),
    ]
)

STATE_CODES_SCHEMA = T.StructType(
    [
        T.StructField("fips_code", T.StringType(), True),
        T.StructField("state_abbr", T.StringType(), True),
        T.StructField("state_name", T.StringType(), True),
    ]
)

VARIABLE_LABELS_SCHEMA = T.StructType(
    [
        T.StructField("source_variable", T.StringType(), True),
        T.StructField("raw_column", T.StringType(), True),
        T.StructField("staged_column", T.StringType(), True),
        T.StructField("coding", T.StringType(), True),
    ]
)

# Column comments of the raw source declaration (attached as StructField
# metadata by ``sources.ingest.describe``).
RAW_COMMENTS = {
    "diabete4": "Ever told you have diabetes",
    "bmi5": "Body mass index times 100; 9999 is missing",
    "ststr": "Stratum of the sample design",
    "psu": "Primary sampling unit",
    "llcpwt": "Final combined survey weight",
    "state": "State FIPS code",
    "survey_year": "Survey year the file was loaded for",
    "loaded_at": "UTC load timestamp, ISO-8601 text",
}
