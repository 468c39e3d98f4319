"""Rating expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncate_rating(c: Column | str) -> Column:
    """double rating -> integer string, truncating toward zero (4.9 -> '4').

    ``try_cast`` keeps the ANSI session from failing on NaN / out-of-range
    values; those become null, as a null rating does.
    """
    return _c(c).try_cast("int").cast("string")


def rating_as_int(c: Column | str) -> Column:
    """Integer value of a rating held as text, or null when it is not numeric.

    Goes through double so that '4.75' reads as 4 (the non-ANSI cast of the
    replaced job truncated decimals) while 'n/a' or '' give null.
    """
    return _c(c).cast("string").try_cast("double").try_cast("int")


def rating_is_malformed(c: Column | str) -> Column:
    """True when a non-null rating is not numeric."""
    col = _c(c)
    return col.isNotNull() & rating_as_int(col).isNull()
