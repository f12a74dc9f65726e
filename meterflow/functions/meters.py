"""Rules about a single reading: nominal values, states, routing."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow.schema import INTERVAL_SECONDS, NOMINAL_VOLTS, ZONES


def by_value(col: Column, mapping: Mapping) -> Column:
    """The mapped value of `col`, NULL for a value outside the mapping."""
    out = None
    for key, value in mapping.items():
        out = F.when(col == key, value) if out is None else out.when(col == key, value)
    return out


def voltage_deviation(voltage: Column, customer_type: Column) -> Column:
    """Distance from the nominal voltage as a fraction of it."""
    nominal = by_value(customer_type, NOMINAL_VOLTS)
    return F.abs(voltage - nominal) / nominal


def interval_seconds(customer_type: Column) -> Column:
    return by_value(customer_type, INTERVAL_SECONDS)


def event_type_of(state: Column) -> Column:
    return F.when(state != "normal", "alert").otherwise("reading")


def zone_partition(zone_id: Column, zones: Sequence[str] = ZONES) -> Column:
    """Partition number of a zone; unknown and missing zones go to 0."""
    return F.coalesce(by_value(zone_id, {z: i for i, z in enumerate(zones)}), F.lit(0))
