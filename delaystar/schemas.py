"""Table schemas (operational store and warehouse) as StructType constants.

Timestamps are TIMESTAMP_NTZ holding UTC; warehouse integers are 64-bit.
"""

from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


STR, INT, LONG, DBL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TS, DATE = T.TimestampNTZType(), T.DateType()

ROUTES = _s(("id", STR, False), ("short_name", STR, False), ("route_type", STR, False))
STOPS = _s(("id", STR, False), ("name", STR, False), ("lat", DBL, True), ("lon", DBL, True))
COLLECTION_RUNS = _s(
    ("id", STR, False), ("started_at", TS, False), ("finished_at", TS, True), ("status", STR, False),
    ("records_saved", INT, False), ("error_message", STR, False),
)
DELAY_OBSERVATIONS = _s(
    ("id", STR, False), ("collection_run_id", STR, False), ("route_id", STR, False), ("stop_id", STR, False),
    ("trip_id", STR, False), ("headsign", STR, False), ("direction_id", STR, False), ("stop_sequence", INT, False),
    ("scheduled_departure", TS, False), ("predicted_departure", TS, False), ("delay_seconds", INT, False),
    ("delay_category", STR, False), ("created_at", TS, False), ("duplicate_key", STR, False),
)
RAW_DELAY_OBSERVATIONS = _s(
    ("observation_id", STR, True), ("collection_run_id", STR, True), ("route_id", STR, True), ("stop_id", STR, True),
    ("trip_id", STR, True), ("headsign", STR, True), ("direction_id", STR, True), ("stop_sequence", LONG, True),
    ("created_at", TS, True), ("scheduled_departure", TS, True), ("predicted_departure", TS, True),
    ("delay_seconds", LONG, True), ("delay_category", STR, True), ("duplicate_key", STR, True),
)
DIM_DATE = _s(
    ("date_key", LONG, True), ("calendar_date", DATE, True), ("year", INT, True), ("month", INT, True),
    ("month_name", STR, True), ("day_of_week_number", INT, True), ("day_type", STR, True),
)
DIM_ROUTE = _s(("route_key", STR, True), ("source_route_id", STR, True), ("route_number", STR, True),
               ("route_name", STR, True), ("route_type", STR, True))
DIM_STOP = _s(("stop_key", STR, True), ("source_stop_id", STR, True), ("stop_name", STR, True),
              ("lat", DBL, True), ("lon", DBL, True))
FACT_DELAY_OBSERVATION = _s(
    ("source_observation_id", STR, True), ("date_key", LONG, True), ("route_key", STR, True),
    ("stop_key", STR, True), ("collection_run_id", STR, True), ("trip_id", STR, True), ("headsign", STR, True),
    ("direction_id", STR, True), ("stop_sequence", LONG, True), ("observed_at", TS, True),
    ("scheduled_departure", TS, True), ("predicted_departure", TS, True), ("delay_seconds", LONG, True),
    ("delay_minutes", DBL, True), ("delay_category", STR, True), ("source_delay_category", STR, True),
    ("time_period", STR, True), ("observation_count", LONG, True),
)

ALL_TABLES = {
    "transit_data/routes": ROUTES,
    "transit_data/stops": STOPS,
    "transit_data/collection_runs": COLLECTION_RUNS,
    "transit_data/delay_observations": DELAY_OBSERVATIONS,
    "raw/delay_observations": RAW_DELAY_OBSERVATIONS,
    "dw/dim_date": DIM_DATE,
    "dw/dim_route": DIM_ROUTE,
    "dw/dim_stop": DIM_STOP,
    "dw/fact_delay_observation": FACT_DELAY_OBSERVATION,
}
