"""Decimal rules for money and ratios.

Sums stay exact decimals.  A ratio is computed as one decimal division with
both sides widened to ``decimal(20, s)`` first so Spark keeps 18 fractional
digits (a ``decimal(38, x) / decimal(38, y)`` would drop to scale 6), then
rounded half-up, and only the final value becomes a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

WIDE = DecimalType(20, 2)


def dec(col: Column | str, precision: int = 20, scale: int = 2) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(DecimalType(precision, scale))


def ratio(num: Column, den: Column) -> Column:
    """num / den as a wide decimal; NULL when den is 0 or NULL."""
    return dec(num, 20, 2) / F.nullif(dec(den, 20, 2), F.lit(0).cast(WIDE))


def money(col: Column, scale: int = 2) -> Column:
    """Round half-up then present as double (the reports' float64)."""
    return F.round(col, scale).cast("double")


def money_text(col: Column) -> Column:
    """Two-decimal text, e.g. 125000.50 (never 125000.5)."""
    return F.round(col, 2).cast(DecimalType(38, 2)).cast("string")
