"""Rounding and exact energy sums."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(col: Column, digits: int) -> Column:
    """Round half away from zero; the guard moves values a hair short of a tie onto it."""
    return F.round(col + F.signum(col) * F.lit(1e-9), digits)


def sum_kwh(col: Column) -> Column:
    """Sum of 4-decimal energies, exact and independent of the row order.

    Adding whole 0.0001 kWh units as longs stays in generated code, where
    a wide decimal sum would not.
    """
    return F.sum(kwh_units(col)) / F.lit(10000.0)


def kwh_units(col: Column) -> Column:
    """Energy in whole units of 0.0001 kWh."""
    return F.rint(col * F.lit(10000.0)).cast("bigint")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """`part` of `whole` in percent, NULL when there is no whole."""
    return round_half_up(part / F.nullif(whole, F.lit(0)) * F.lit(100.0), digits)
