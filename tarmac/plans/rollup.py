"""Partial-state rollups fed from the fact table (MOD-08, MOD-09)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tarmac.operators.partial_state import partial_state

# state column -> fact column
CARRIER_STATES = {
    "total_flights_state": "arr_flights",
    "total_delayed_state": "arr_del15",
    "total_delay_minutes_state": "arr_delay",
    "total_carrier_delay_state": "carrier_delay",
    "total_weather_delay_state": "weather_delay",
    "total_nas_delay_state": "nas_delay",
    "total_security_delay_state": "security_delay",
    "total_late_aircraft_delay_state": "late_aircraft_delay",
}
MONTHLY_STATES = {
    "total_flights_state": "arr_flights",
    "total_delayed_state": "arr_del15",
    "total_delay_minutes_state": "arr_delay",
}


def carrier_state(fact: DataFrame) -> DataFrame:
    """Per (year slice, carrier_key, carrier) partial sums."""
    return partial_state(fact, ["carrier_key", "carrier"], CARRIER_STATES)


def monthly_state(fact: DataFrame) -> DataFrame:
    """Per (year slice, date_key, month) partial sums."""
    return partial_state(fact, ["date_key", "year", "month"], MONTHLY_STATES)
