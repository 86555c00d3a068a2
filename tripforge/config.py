"""Tunables and fixed contract constants.

The thresholds are parameters of the operators (one frozen dataclass), not
globals read at run time, so a job is fully described by its arguments.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    """Outlier bounds applied after the contract."""

    min_trip_duration_min: float = 0.5
    max_trip_duration_min: float = 180.0
    max_trip_speed_mph: float = 100.0
    min_fare_amount: float = 0.01
    min_passenger_count: float = 1.0

    def __post_init__(self) -> None:
        if self.min_trip_duration_min < 0:
            raise ValueError("min_trip_duration_min must be >= 0")
        if self.max_trip_duration_min <= 0:
            raise ValueError("max_trip_duration_min must be > 0")
        if self.max_trip_speed_mph <= 0:
            raise ValueError("max_trip_speed_mph must be > 0")
        if self.min_passenger_count < 0:
            raise ValueError("min_passenger_count must be >= 0")


DEFAULT_THRESHOLDS = Thresholds()

DEFAULT_TAXI_TYPE = "yellow"
TOP_REASONS_LIMIT = 5

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's contract for identical results.
# ---------------------------------------------------------------------------
VALID_VENDOR_IDS = (1, 2, 6, 7)
VALID_RATE_CODES = (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 99.0)
VALID_PAYMENT_TYPES = (0, 1, 2, 3, 4, 5, 6)
VALID_STORE_AND_FWD_FLAGS = ("Y", "N")
LOCATION_ID_MIN = 1
LOCATION_ID_MAX = 265
MONEY_MIN = -1000.0
MONEY_MAX = 10000.0
DISTANCE_MAX = 500.0
PASSENGER_MIN = 0
PASSENGER_MAX = 9
# Half-open hour ranges [start, end) -> time-of-day label.
TIME_OF_DAY_BUCKETS = (
    (0, 6, "night"),
    (6, 12, "morning"),
    (12, 17, "afternoon"),
    (17, 21, "evening"),
    (21, 24, "night"),
)
# Inclusive weekday rush-hour windows.
RUSH_HOURS = ((7, 9), (16, 18))
# Outlier reason names, in report order.
OUTLIER_REASONS = (
    "duration_too_short",
    "duration_too_long",
    "speed_implausible",
    "non_positive_fare",
    "zero_distance",
    "too_few_passengers",
)
