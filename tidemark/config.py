"""Configuration: column mapping, fixed lookup values, thresholds, mode flags.

Everything that must equal the analysed pipeline's behaviour lives here as
plain data so it can be overridden per job.
"""

from __future__ import annotations


# --------------------------------------------------------------------------
# FIXED VALUES (must equal the analysed pipeline's tables; do not reorder)
# --------------------------------------------------------------------------

# Channel code -> channel group. Case-sensitive; anything else (and null)
# maps to UNKNOWN_GROUP.
CHANNEL_GROUPS: dict[str, str] = {
    "WEB": "WEB",
    "GDS": "OTA/GDS",
    "CRS": "OTA/GDS",
    "INTERNET": "OTA/GDS",
    "GOOG": "OTA/GDS",
    "EMAIL": "OTA/GDS",
    "IDS": "OTA/GDS",
    "RL": "Direct",
    "PMS": "Direct",
    "DCI": "Direct",
    "WI": "Direct",
    "HOUSE": "Direct",
    "SAL": "Direct",
    "SYDC": "Corporate",
    "GCI": "Corporate",
    "MARKETING": "Corporate",
    "CHOPRA": "Specialty",
}
UNKNOWN_GROUP = "Unknown"

# The six channel groups, in the column order used for the boolean dummies.
CHANNEL_GROUP_NAMES: tuple[str, ...] = (
    "Corporate", "Direct", "OTA/GDS", "Specialty", "Unknown", "WEB",
)

# RFM total score (3..15) -> segment name, checked from the top down:
# score >= bound gives the name.
RFM_SEGMENT_BOUNDS: tuple[tuple[int, str], ...] = (
    (13, "Champions"),
    (10, "Loyal Customers"),
    (7, "Potential Loyalists"),
    (4, "At Risk"),
)
RFM_SEGMENT_FLOOR = "Lost"

# CLV level by absolute value (scoring): value < bound gives the level.
CLV_LEVEL_BOUNDS_ONETIMER: tuple[float, float, float] = (50.0, 150.0, 300.0)
CLV_LEVEL_BOUNDS_REPEATER: tuple[float, float, float] = (200.0, 500.0, 1000.0)
CLV_LEVELS: tuple[str, str, str, str] = ("Low", "Mid", "High", "Top")

# Mismatch labels and the segment sets that trigger them.
HIGH_RFM_SEGMENTS: tuple[str, ...] = ("Champions", "Loyal Customers")
LOW_RFM_SEGMENTS: tuple[str, ...] = ("At Risk", "Lost")
MISMATCH_OVERRATED = "Overrated (High RFM, Low CLV)"
MISMATCH_UNDERRATED = "Underrated (Low RFM, High CLV)"
MISMATCH_ALIGNED = "Aligned"

# Group labels of the combined CLV table.
GROUP_ONETIMER = "onetimer"
GROUP_REPEATER = "repeater"
# Customer-type labels of the lenient preparation.
TYPE_ONETIMER = "one_timer"
TYPE_REPEATER = "repeater"

# No-model fallbacks used by scoring.
FALLBACK_P_RETURN = 0.1
FALLBACK_P_ALIVE = 0.5
# Lenient scoring: constant RFM score / segment, and the lookup default.
LENIENT_RFM_SCORE = 9
LENIENT_SEGMENT = "Potential Loyalists"
MISSING_RFM_SCORE = 0
MISSING_SEGMENT = "Unknown"

# Target-list defaults (exploratory analysis).
TARGET_LEVELS: tuple[str, ...] = ("High", "Top")
TARGET_EXCLUDED_SEGMENTS: tuple[str, ...] = ("Lost",)
TARGET_CHANNEL_GROUPS: tuple[str, ...] = ("WEB", "EMAIL", "GDS", "Direct")

# Request defaults.
DEFAULT_SNAPSHOT = "2025-06-04"
DEFAULT_XDAYS = 365
# Lenient revenue fallback when no revenue-like column exists.
DEFAULT_REVENUE = 100.0
# Training-file discovery: names tried first, then any *.csv.
KNOWN_TRAINING_FILES: tuple[str, ...] = (
    "transactions.csv", "data.csv", "train.csv", "clv_data.csv", "clv_training_data.csv",
)
# Minimum customers for a per-channel Cox model.
MIN_CHANNEL_ROWS = 100

# Further date columns of the lenient extract.
LENIENT_DATES = ("Departure Date", "Booked Date")

# Source column names of the transaction extract.
SOURCE_COLUMNS = {
    "customer_id": "CustomerID",
    "arrival_ts": "Arrival Date",
    "revenue": "Total Revenue USD",
    "channel": "Channel",
}

# Channel codes used by the test-data mapping over `orders`:
# the 17 mapped codes in table order, then an unmapped code, then null.
TESTDATA_CHANNEL_CODES: tuple[str | None, ...] = tuple(CHANNEL_GROUPS) + ("RANDOM", None)

# Default snapshot for the test-data queries.
TESTDATA_SNAPSHOT = "1996-01-01"

