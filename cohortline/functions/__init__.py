"""Column expressions: markers for missing values, codes, keys."""

from cohortline.functions.codes import conditional_code, encode
from cohortline.functions.keys import hash_fraction_bucket, hash_hex, row_key
from cohortline.functions.markers import (
    LABEL_PLACEHOLDER, NULL_MARKERS, differs_from, fold_markers, to_int, to_number,
)
from cohortline.functions.scores import class_from_probability, positive_probability

__all__ = [
    "LABEL_PLACEHOLDER", "NULL_MARKERS", "class_from_probability", "conditional_code",
    "differs_from", "encode", "fold_markers", "hash_fraction_bucket", "hash_hex",
    "positive_probability", "row_key", "to_int", "to_number",
]
