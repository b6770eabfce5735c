"""Fixed values and job defaults.

FIXED VALUES — these must stay equal to the behaviour of the system being
reproduced (names, thresholds, labels and limits).  They are stated plainly and
together so they can be audited in one place.
"""

# --- FIXED VALUES -----------------------------------------------------------

# Local zone used for every calendar/hour attribute of an observation.
LOCAL_ZONE = "Europe/Budapest"

# Name of the reporting view.
DASHBOARD_VIEW_NAME = "v_delay_dashboard"

# Route numbers in scope of the reporting view.
REPORT_ROUTE_NUMBERS = ("4", "6")

# Route number from a route id (snapshot scope): the digits of the id equal or
# end with these codes, else a trailing 4 or 6 not preceded by a digit.
ROUTE_NUMBER_CODES = (("4", ("3040", "4"), "3040"), ("6", ("3060", "6"), "3060"))
TRAILING_ROUTE_NUMBER_PATTERN = r"(?:^|[^0-9])([46])$"

# Warehouse delay categories: upper bound in seconds (inclusive), then label.
WAREHOUSE_ON_TIME_MAX = 60
WAREHOUSE_MINOR_MAX = 180
WAREHOUSE_SIGNIFICANT_MAX = 300
ON_TIME = "on time"
MINOR_DELAY = "minor delay"
SIGNIFICANT_DELAY = "significant delay"
SEVERE_DELAY = "severe delay"
CATEGORY_ORDER = (ON_TIME, MINOR_DELAY, SIGNIFICANT_DELAY, SEVERE_DELAY)
SIGNIFICANT_OR_SEVERE = (SIGNIFICANT_DELAY, SEVERE_DELAY)

# Operational delay categories (collection time): early below -60 s,
# on_time up to 60 s, minor_delay up to 180 s, medium_delay up to 360 s,
# major_delay above.
OPERATIONAL_EARLY_BELOW = -60
OPERATIONAL_ON_TIME_MAX = 60
OPERATIONAL_MINOR_MAX = 180
OPERATIONAL_MEDIUM_MAX = 360
OPERATIONAL_CATEGORIES = ("early", "on_time", "minor_delay", "medium_delay", "major_delay")
# Operational name that the snapshot display maps onto a warehouse name.
MAJOR_DELAY_DISPLAY = ("major delay", SIGNIFICANT_DELAY)

# A departure counts as delayed above this many seconds.
DELAYED_ABOVE_SECONDS = 60

# Time periods by local hour, both bounds inclusive.
MORNING_PEAK = ("morning peak", 6, 9)
AFTERNOON_PEAK = ("afternoon peak", 15, 18)
OTHER_PERIOD = "other period"
PERIOD_ORDER = ("morning peak", "afternoon peak", "other period")

# Route name is built as "<route_type> line <route_number>".
ROUTE_NAME_INFIX = " line "

# Day type by day of week (Sunday = 1 ... Saturday = 7).
WEEKEND_DAYS = (1, 7)
WEEKEND = "weekend"
WEEKDAY = "weekday"

# Headsigns that the snapshot statistics merge into one label, compared
# without accents and case.
MERGED_HEADSIGN = "Újbuda-központ M / Móricz Zsigmond körtér M"
MERGED_HEADSIGN_KEYS = ("ujbuda-kozpont m", "moricz zsigmond korter m")
UNKNOWN_HEADSIGN = "unknown"

# Observation ids are UUIDv5 in the URL namespace of the natural key
# "trip|stop|scheduled-isoformat"; timestamps are written with "+00:00".
UUID_NAMESPACE_URL_HEX = "6ba7b8119dad11d180b400c04fd430c8"
KEY_SEPARATOR = "|"
UTC_OFFSET_TEXT = "+00:00"

# Result limits.
RANKING_LIMIT = 15
SNAPSHOT_RANKING_LIMIT = 10
HISTORY_LIMIT = 50
AUDIT_PREVIEW_LIMIT = 20
SEARCH_LIMIT = 11
PARSE_LIMIT = 3
COLLECTOR_DEPARTURE_LIMIT = 4
SEARCH_MIN_QUERY_CHARS = 4

# Average delay (minutes) below which the KPI meets its target.
KPI_TARGET_MINUTES = 3.0
KPI_TARGET_OK = "target-ok"
KPI_TARGET_WARNING = "target-warning"

# Incremental overlap window.
OVERLAP_DAYS = 2

# Collection summary states.
COLLECTION_SUCCESS = "success"
COLLECTION_PARTIAL = "partial_success"
COLLECTION_FAILED = "failed"
PAYLOAD_OK_STATUS = "OK"

# Display placeholders.
MISSING_TEXT = "-"
UNKNOWN_NAME = "unknown"

# Stops monitored by the scheduled collector:
# (stop_id, stop_name, route_short_names, direction_label).
# Names are kept exactly, including a trailing space.
MONITORED_STOPS = (
    ("BKK_F00199", "Mechwart liget", ("4", "6"), "Ujbuda / Moricz direction"),
    ("BKK_F00198", "Mechwart liget", ("4", "6"), "Szell Kalman direction"),
    ("BKK_F00192", "Margit hid, budai hidfo H", ("4", "6"), "Szell Kalman direction"),
    ("BKK_F00189", "Margit hid, budai hidfo H", ("4", "6"), "Ujbuda / Moricz direction"),
    ("BKK_F00926", "Jaszai Mari ter", ("4", "6"), "Ujbuda / Moricz direction"),
    ("BKK_F00925", "Jaszai Mari ter", ("4", "6"), "Szell Kalman direction"),
    ("BKK_F00935", "Nyugati palyaudvar M", ("4", "6"), "Ujbuda / Moricz direction"),
    ("BKK_F00933", "Nyugati palyaudvar M", ("4", "6"), "Szell Kalman direction"),
    ("BKK_F01082", "Oktogon M", ("4", "6"), "Szell Kalman direction"),
    ("BKK_F01081", "Oktogon M", ("4", "6"), "Ujbuda / Moricz direction"),
    ("BKK_F01037", "Kiraly utca / Erzsebet korut", ("4", "6"), "Ujbuda / Moricz direction"),
    ("BKK_F01035", "Kiraly utca / Erzsebet korut", ("4", "6"), "Szell Kalman direction"),
    ("BKK_F01169", "Blaha Lujza ter M", ("4", "6"), "Ujbuda / Moricz direction"),
    ("BKK_F01168", "Blaha Lujza ter M", ("4", "6"), "Szell Kalman direction"),
    ("BKK_F01199", "Harminckettesek tere ", ("4", "6"), "Szell Kalman direction"),
    ("BKK_F01197", "Harminckettesek tere ", ("4", "6"), "Ujbuda / Moricz direction"),
    ("BKK_F01194", "Corvin-negyed M", ("4", "6"), "Ujbuda / Moricz direction"),
    ("BKK_F01191", "Corvin-negyed M", ("4", "6"), "Szell Kalman direction"),
    ("BKK_F02225", "Petofi hid, budai hidfo", ("4", "6"), "Szell Kalman direction"),
    ("BKK_F02224", "Petofi hid, budai hidfo", ("4", "6"), "Ujbuda / Moricz direction"),
)
