"""Decimal amounts: rounding is half away from zero, as SQL ROUND does."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Service share of a booking, fee and net share of a payment.
SERVICE_SHARE = Decimal("0.10")
FEE_SHARE = Decimal("0.03")
NET_SHARE = Decimal("0.97")


def share(amount: Column, part: Decimal, result: str = "decimal(12,2)") -> Column:
    return F.round(amount * F.lit(part), 2).cast(result)


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole`` as decimal(5,2)."""
    ratio = part.cast("decimal(20,1)") * F.lit(Decimal("100.0")) / whole.cast("decimal(20,0)")
    return ratio.cast("decimal(5,2)")
