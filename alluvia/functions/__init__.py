"""Column-level building blocks: every one returns a Column built from Spark's own functions."""

from alluvia.functions.arrays import array_text, element_columns, safe_size, struct_columns, unnest
from alluvia.functions.audit import date_parts, with_audit
from alluvia.functions.hashing import row_hash, surrogate_key
from alluvia.functions.labels import contains_any, first_label, is_whole_number, threshold_label
from alluvia.functions.text import leading_number, strip_markup

__all__ = [
    "array_text", "contains_any", "date_parts", "element_columns", "first_label", "is_whole_number",
    "leading_number", "row_hash", "safe_size", "strip_markup", "struct_columns", "surrogate_key",
    "threshold_label", "unnest", "with_audit",
]
