"""Canonical column names of the panel and its sources.

Fixed values: the panel keeps the reference's output names so that downstream
code written against its files keeps working.
"""

KEY = "municipio_key"
NAME = "municipio_name"
DATE = "date"
TARGET = "flood_next_24h"

STATION = "station_code"

# Event keywords that mark a flood event (fixed values of the reference).
FLOOD_EVENT_KEYWORDS = ("inund", "crecient", "avenida torrencial", "desbord")

CALENDAR_COLUMNS = ("year", "month", "day", "day_of_year", "day_of_week", "is_weekend")

NON_FEATURES = (KEY, NAME, DATE, TARGET)
