"""Scalar building blocks, all built-in Spark expressions (JVM side, codegen)."""

from .parsing import (business_date_from_name, parse_amount, parse_entry_date,
                      parse_iso_date, parse_trans_date)
from .text import any_differs, full_name

__all__ = [
    "any_differs", "business_date_from_name", "full_name", "parse_amount",
    "parse_entry_date", "parse_iso_date", "parse_trans_date",
]
