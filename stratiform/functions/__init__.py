"""Column builders: codebook decoding, survey estimators, row flags."""

from stratiform.functions.codebooks import as_code, decode, decode_bool, sentinel_scaled
from stratiform.functions.estimators import (
    conditional_count,
    count_rows,
    millions,
    percent,
    safe_ratio,
    suppress,
    unweighted_proportion,
    weighted_count,
    weighted_mean,
    weighted_proportion,
    weighted_total,
)

__all__ = [
    "as_code",
    "conditional_count",
    "count_rows",
    "decode",
    "decode_bool",
    "millions",
    "percent",
    "safe_ratio",
    "sentinel_scaled",
    "suppress",
    "unweighted_proportion",
    "weighted_count",
    "weighted_mean",
    "weighted_proportion",
    "weighted_total",
]
