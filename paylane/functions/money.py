"""Amounts. Money is decimal from the scan to the printed field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Print formats of amounts and of country numbers.
MONEY_FORMAT = "S0000000000000.00"
ID_FORMAT = "000"


def scale(c: Column, factor: Column) -> Column:
    """Minor units to currency units; a missing amount is zero."""
    return F.coalesce(c / factor, F.lit(0))


def money_text(c: Column) -> Column:
    """Sign, 13 digits, point, 2 digits."""
    return F.to_char(F.round(c, 2).cast("decimal(38,2)"), F.lit(MONEY_FORMAT))


def padded_id(c: Column) -> Column:
    """Three digits with leading zeros; a longer number prints as ``#``, never cut."""
    return F.to_char(c.cast("decimal(38,0)"), F.lit(ID_FORMAT))
