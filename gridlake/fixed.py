"""Fixed values that must equal the published reference tables.

FIXED VALUES -- kept as plain text, in their natural order, together.
"""

# Default local zone for time-of-use windows.
LOCAL_ZONE = "Europe/Oslo"

# Quality label of a clean reading, and the sentinel label whose kWh is nulled.
GOOD = "GOOD"
MISSING = "MISSING"

# Tariff catalogue: (tariff_code, tariff_name, standing_charge, currency).
TARIFFS = [
    ("standard", "Standard Flat", 0.45, "EUR"),
    ("economy7", "Economy 7", 0.48, "EUR"),
    ("ev_special", "EV Overnight", 0.55, "EUR"),
    ("green", "100% Green", 0.50, "EUR"),
]

# Time-of-use windows [start_hour, end_hour) in local time:
# (tariff_code, period_name, start_hour, end_hour, unit_rate).
TARIFF_RATES = [
    ("standard", "all_day", 0, 24, 0.28),
    ("economy7", "night", 0, 7, 0.14),
    ("economy7", "day", 7, 24, 0.31),
    ("ev_special", "ev_window", 0, 5, 0.09),
    ("ev_special", "day", 5, 24, 0.30),
    ("green", "all_day", 0, 24, 0.32),
]

# Month -> season.
SEASONS = {
    12: "winter", 1: "winter", 2: "winter",
    3: "spring", 4: "spring", 5: "spring",
    6: "summer", 7: "summer", 8: "summer",
    9: "autumn", 10: "autumn", 11: "autumn",
}

# The single metering location: (location_id, city, country, latitude, longitude).
LOCATION = (1, "Oslo", "NO", 59.91, 10.75)

# Analysis window of the published data set (both ends inclusive).
WINDOW_START = "2025-06-29"
WINDOW_END = "2026-06-29"

# Hourly weather variables, in request order.
HOURLY_VARS = [
    "temperature_2m",
    "apparent_temperature",
    "relative_humidity_2m",
    "cloud_cover",
    "wind_speed_10m",
    "shortwave_radiation",
]

# Customer segment written into every customer row.
SEGMENT = "residential"
