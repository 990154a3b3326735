"""String helpers: the report's full name and null-safe change detection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(last="last_name", first="first_name", patronymic="patronymic") -> Column:
    """``last || ' ' || first || ' ' || patronymic``; any null part makes the name null."""
    return F.concat(F.col(last), F.lit(" "), F.col(first), F.lit(" "), F.col(patronymic))


def any_differs(columns, left: str, right: str) -> Column:
    """True when at least one attribute differs between two row aliases, null-safe.

    A null on one side against a value on the other counts as a change; null against null
    does not.
    """
    checks = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a | b, checks, F.lit(False))
