"""Text-to-typed conversions used when staging rows become facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

AMOUNT_TYPE = T.DecimalType(7, 2)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_amount(c) -> Column:
    """``'12,34'`` -> ``12.34`` as ``decimal(7,2)`` (decimal comma; half-up rounding).

    The fraction is kept (a bare ``decimal`` cast in Spark would drop it). An amount that
    does not fit ``decimal(7,2)`` raises under ANSI mode, like the warehouse column would.
    """
    return F.regexp_replace(_col(c), ",", ".").cast(AMOUNT_TYPE)


def parse_trans_date(c) -> Column:
    """``'YYYY-MM-DD HH:MM:SS[.ffffff]'`` -> ``timestamp_ntz`` rounded to whole seconds.

    The fact column is ``timestamp(0)``: fractions of a second round half-up.
    """
    ts = F.to_timestamp_ntz(_col(c))
    # interval arithmetic keeps the wall clock; date_trunc would pass through the session zone
    secs = F.date_part(F.lit("SECOND"), ts)
    frac = secs - F.floor(secs)
    whole = ts - F.make_dt_interval(secs=frac)
    return F.when(frac >= 0.5, whole + F.make_dt_interval(secs=F.lit(1))).otherwise(whole)


def parse_entry_date(c) -> Column:
    """Blacklist ``entry_dt`` text -> ``date``."""
    return _col(c).cast(T.DateType())


def parse_iso_date(c) -> Column:
    """``to_date(text, 'YYYY-MM-DD')``."""
    return F.to_date(_col(c), "yyyy-MM-dd")


def business_date_from_name(c) -> Column:
    """Business date encoded as ``_DDMMYYYY.`` in a drop file name or path -> ``date``
    (the last such group of a path wins)."""
    return F.to_date(F.regexp_extract(_col(c), r".*_(\d{8})\.", 1), "ddMMyyyy")
