from tablesync.functions.clean import (
    blank_to_null,
    json_field,
    parse_total,
    py_strip,
    redact,
    sanitize,
    sanitize_blanks,
    sanitize_value,
    strip_nul,
    strip_nul_all,
    to_json_record,
)
from tablesync.functions.types import added_column_type, narrow_plan, narrow_types

__all__ = [
    "added_column_type", "blank_to_null", "json_field", "narrow_plan", "narrow_types",
    "parse_total", "py_strip", "redact", "sanitize", "sanitize_blanks", "sanitize_value",
    "strip_nul", "strip_nul_all", "to_json_record",
]
