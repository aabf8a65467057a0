"""Column-level functions (JVM-side expressions, no Python UDFs)."""

from recprep.functions.arrays import (
    concat_scalar, list_difference, list_get, list_head, list_len, list_tail,
    pad_left, pad_right, padding_mask, to_padded,
)
from recprep.functions.random import uniform
from recprep.functions.scalar import (
    blank_to_unknown, clip_outlier_to, decade_of, dcg_discount, fill_null,
    impute_blank, logistic_loss, parse_year, sigmoid,
)

__all__ = [
    "uniform", "decade_of", "parse_year", "blank_to_unknown", "impute_blank",
    "clip_outlier_to", "fill_null", "logistic_loss", "sigmoid", "dcg_discount",
    "concat_scalar", "list_difference", "list_get", "list_head", "list_len",
    "list_tail", "pad_left", "pad_right", "padding_mask", "to_padded",
]
