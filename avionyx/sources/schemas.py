"""Declared schemas of the five sources and of the six warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, F32, D, B, TS, DT = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.FloatType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampNTZType(),
    T.DateType(),
)


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# --- sources -----------------------------------------------------------------

FLIGHTS = _struct(
    ("id", L, True),
    ("aircraftregistration", S, True),
    ("scheduleddeparture", TS, True),
    ("scheduledarrival", TS, True),
    ("actualdeparture", TS, True),
    ("actualarrival", TS, True),
    ("cancelled", B, True),
    ("delaycode", S, True),
)

MAINTENANCE = _struct(
    ("aircraftregistration", S, True),
    ("scheduleddeparture", TS, True),
    ("scheduledarrival", TS, True),
    ("programmed", B, True),
)

REPORTS = _struct(
    ("pfrid", L, True),
    ("aircraftregistration", S, True),
    ("reportingdate", TS, True),
    ("reporteurid", S, True),
    ("reporteurclass", S, True),
)

# CSV lookups are text only.
AIRCRAFT_LOOKUP = _struct(
    ("aircraft_reg_code", S, True),
    ("manufacturer_serial_number", S, True),
    ("aircraft_model", S, True),
    ("aircraft_manufacturer", S, True),
)

PERSONNEL = _struct(
    ("reporteurid", S, True),
    ("airport", S, True),
)

# --- warehouse ---------------------------------------------------------------

AIRCRAFTS = _struct(
    ("Aircraft_ID", I, False),
    ("Aircraft_Registration_Code", S, False),
    ("Manufacturer_Serial_Number", S, True),
    ("Aircraft_Model", S, True),
    ("Aircraft_Manufacturer_Class", S, True),
)

DATES = _struct(
    ("Date_ID", I, False),
    ("Full_Date", DT, False),
    ("Day_Num", I, False),
    ("Month_Num", I, False),
    ("Year", I, False),
)

MONTHS = _struct(
    ("Month_ID", I, False),
    ("Month_Num", I, False),
    ("Year", I, False),
)

FLIGHT_OPERATIONS_DAILY = _struct(
    ("Date_ID", I, False),
    ("Aircraft_ID", I, False),
    ("FH", F32, False),
    ("Takeoffs", I, False),
    ("DFC", I, False),
    ("CFC", I, False),
    ("TDM", F32, False),
)

AIRCRAFT_MONTHLY_SUMMARY = _struct(
    ("Month_ID", I, False),
    ("Aircraft_ID", I, False),
    ("ADIS", F32, False),
    ("ADOSS", F32, False),
    ("ADOSU", F32, False),
)

LOGBOOKS = _struct(
    ("Month_ID", I, False),
    ("Aircraft_ID", I, False),
    ("Airport", S, False),
    ("Log_Count", I, False),
)

WAREHOUSE_TABLES = {
    "Aircrafts": AIRCRAFTS,
    "Dates": DATES,
    "Months": MONTHS,
    "Flight_Operations_Daily": FLIGHT_OPERATIONS_DAILY,
    "Aircraft_Monthly_Summary": AIRCRAFT_MONTHLY_SUMMARY,
    "Logbooks": LOGBOOKS,
}

# Fixed values of the warehouse: the manufacturer domain of the Aircrafts
# dimension, in declaration order.
MANUFACTURERS = ("Airbus", "Boeing")
