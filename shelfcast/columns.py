"""Column names and horizon constants shared by every module."""

HORIZON = 28
LABEL = "Value"
HIERARCHY = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
SERIES_COLS = ["id", *HIERARCHY]
EVENT_COLS = ["event_name_1", "event_type_1", "event_name_2", "event_type_2"]
FORECAST_COLS = [f"F{h}" for h in range(1, HORIZON + 1)]

# A frame keyed by day is broadcast only up to this many rows (200 years).
DAY_LIMIT = 73_050
# A value dictionary is numbered in one task only up to this many rows.
DICTIONARY_LIMIT = 1_000_000
