"""Fixed values.

These must equal the values the original application uses for its results to
be comparable; every operator takes them as keyword parameters defaulting to
the values below.
"""

# --- fixed values (natural order, together) ---------------------------------
SERVICE_ZONE = "Australia/Sydney"      # calendar of the service day
LATE_SECONDS = 300                     # late: delay > 300 s; on time: delay <= 300 s
RAIN_MM = 0.2                          # raining: precipitation >= 0.2 mm (missing = 0)
SUBURBAN_LINE_PATTERN = "^T[0-9]"      # suburban line codes: T1, T2, ...
NON_REVENUE_PREFIX = "RTTA"            # route_id LIKE 'RTTA%' is a non-revenue run
MIN_STOP_EVENTS = 20                   # stop_punctuality HAVING count(*) >= 20
MIN_LINE_EVENTS = 25                   # worst_lines HAVING count(*) >= 25
WORST_LINES_LIMIT = 8
TOP_K = 6                              # top_lines / top_hours / top_stations
WIDGET_STATIONS_LIMIT = 15
SCENARIO_WET_MM = 2.0                  # scenario precipitation when raining
SCENARIO_DRY_MM = 0.0
PREDICT_THRESHOLD = 0.5
LIKELY_LATE = "LIKELY LATE"
PROBABLY_ON_TIME = "probably on time"
WET_LABEL, DRY_LABEL = "Wet", "Dry"
TEST_FRACTION = 0.25
SPLIT_SEED = 42
MIN_POSITIVES_TO_STRATIFY = 8
MAX_ITER = 2000
# GTFS-Realtime schedule relationships (proto3-JSON enum name -> code)
STOP_RELATIONSHIP = {"SCHEDULED": 0, "SKIPPED": 1, "NO_DATA": 2, "UNSCHEDULED": 3}
TRIP_RELATIONSHIP = {"SCHEDULED": 0, "ADDED": 1, "UNSCHEDULED": 2, "CANCELED": 3,
                     "REPLACEMENT": 5, "DUPLICATED": 6, "DELETED": 7}
# -----------------------------------------------------------------------------
