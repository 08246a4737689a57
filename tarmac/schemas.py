"""Table contracts of every layer (bronze, silver, gold, marts, checks)."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names, order and types of this module are the data contract.
KEY_COLUMNS = ["year", "month", "carrier", "airport"]

COUNT_COLUMNS = ["arr_flights", "arr_del15", "arr_cancelled", "arr_diverted"]
CAUSE_COUNT_COLUMNS = ["carrier_ct", "weather_ct", "nas_ct", "security_ct", "late_aircraft_ct"]
DELAY_COLUMNS = [
    "arr_delay",
    "carrier_delay",
    "weather_delay",
    "nas_delay",
    "security_delay",
    "late_aircraft_delay",
]
DECIMAL_COLUMNS = CAUSE_COUNT_COLUMNS + DELAY_COLUMNS

# Order of the 21 measure/identity columns in the source file.
CSV_COLUMNS = [
    "year",
    "month",
    "carrier",
    "carrier_name",
    "airport",
    "airport_name",
    "arr_flights",
    "arr_del15",
    "carrier_ct",
    "weather_ct",
    "nas_ct",
    "security_ct",
    "late_aircraft_ct",
    "arr_cancelled",
    "arr_diverted",
    "arr_delay",
    "carrier_delay",
    "weather_delay",
    "nas_delay",
    "security_delay",
    "late_aircraft_delay",
]
MEASURE_COLUMNS = CSV_COLUMNS[6:]

# Wide enough that staging rounds the source value once.
BRONZE_DECIMAL = T.DecimalType(32, 18)
SILVER_DECIMAL = T.DecimalType(10, 2)


def _field(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


BRONZE_CSV = T.StructType(
    [_field(c, T.IntegerType()) for c in CSV_COLUMNS[:2]]
    + [_field(c, T.StringType()) for c in CSV_COLUMNS[2:6]]
    + [_field(c, BRONZE_DECIMAL) for c in MEASURE_COLUMNS]
)

BRONZE = T.StructType(BRONZE_CSV.fields + [_field("_ingested_at", T.TimestampType())])

# Declared length limits of the bronze text columns (checked, not enforced).
BRONZE_TEXT_LIMITS = {"carrier": 10, "carrier_name": 100, "airport": 10, "airport_name": 200}

STAGING_COLUMNS = (
    ["airline_delay_id", "year", "month", "carrier", "airport", "carrier_name", "airport_name"]
    + COUNT_COLUMNS
    + CAUSE_COUNT_COLUMNS
    + DELAY_COLUMNS
    + ["_ingested_at"]
)

STAGING = T.StructType(
    [
        _field("airline_delay_id", T.StringType()),
        _field("year", T.IntegerType()),
        _field("month", T.IntegerType()),
        _field("carrier", T.StringType()),
        _field("airport", T.StringType()),
        _field("carrier_name", T.StringType()),
        _field("airport_name", T.StringType()),
    ]
    + [_field(c, T.IntegerType()) for c in COUNT_COLUMNS]
    + [_field(c, SILVER_DECIMAL) for c in DECIMAL_COLUMNS]
    + [_field("_ingested_at", T.TimestampType())]
)

DIM_CARRIER_COLUMNS = ["carrier_key", "carrier", "carrier_name"]
DIM_AIRPORT_COLUMNS = ["airport_key", "airport", "airport_name"]
DIM_DATE_COLUMNS = ["date_key", "year", "month", "quarter", "month_name", "year_month"]

FACT_COLUMNS = (
    [
        "airline_delay_id",
        "date_key",
        "carrier_key",
        "airport_key",
        "year",
        "month",
        "carrier",
        "carrier_name",
        "airport",
        "airport_name",
    ]
    + COUNT_COLUMNS
    + CAUSE_COUNT_COLUMNS
    + DELAY_COLUMNS
    + ["_ingested_at"]
)

CHECK_RESULT = T.StructType(
    [
        _field("check", T.StringType(), False),
        _field("layer", T.StringType(), False),
        _field("severity", T.StringType(), False),
        _field("violations", T.LongType(), False),
        _field("passed", T.BooleanType(), False),
        _field("description", T.StringType(), False),
    ]
)
