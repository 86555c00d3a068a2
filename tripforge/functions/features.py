"""Derived feature expressions (F1-F13), as Spark SQL expression text.

Undefined ratios are NULL (never NaN, never a division error): every division
is guarded by a CASE on its denominator.  The projection is one
``selectExpr`` (a single call from Python), repeated sub-expressions such as
the duration are shared by Catalyst's subexpression elimination.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripforge import config as C

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

FEATURE_COLUMNS = (
    "trip_duration_min", "trip_speed_mph", "pickup_hour", "pickup_dayofweek",
    "pickup_day_name", "is_weekend", "time_of_day", "is_rush_hour",
    "fare_per_mile", "tip_pct", "cost_per_min", "is_airport_trip", "pickup_date",
)

P, D_ = f"`{PICKUP}`", f"`{DROPOFF}`"
# exact difference in minutes, of wall-clock times whatever the session's zone
# (an interval's microseconds as a decimal of seconds; ``timestampdiff`` took fifteen times as long)
DURATION = f"(CAST(try_cast(CAST({D_} - {P} AS INTERVAL SECOND) AS DECIMAL(18, 6)) AS DOUBLE) / CAST(60 AS DOUBLE))"
HOUR = f"hour({P})"
WEEKDAY = f"weekday({P})"  # Monday = 0
PICKUP_DATE = f"date_format({P}, 'yyyy-MM-dd')"
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def time_of_day_sql(hour: str = HOUR) -> str:
    """half-open hour buckets."""
    arms = " ".join(f"WHEN {hour} >= {lo} AND {hour} < {hi} THEN '{label}'"
                    for lo, hi, label in C.TIME_OF_DAY_BUCKETS)
    return f"CASE {arms} END"


def rush_hour_sql(weekday: str = WEEKDAY, hour: str = HOUR) -> str:
    """F8: Monday-Friday and hour inside one of the inclusive windows."""
    windows = " OR ".join(f"{hour} BETWEEN {lo} AND {hi}" for lo, hi in C.RUSH_HOURS)
    return f"({weekday} < 5 AND ({windows}))"


def day_name_sql(weekday: str = WEEKDAY) -> str:
    """the English name from the day's number (no pattern formatting per row)."""
    names = ", ".join(f"'{n}'" for n in DAY_NAMES)
    return f"element_at(array({names}), {weekday} + 1)"


def feature_exprs(columns: list[str]) -> dict[str, str]:
    """Each derived column's expression over the coerced columns, in output order."""
    dur, dist, fare = DURATION, "`trip_distance`", "`fare_amount`"
    dur_h = f"({dur} / CAST(60 AS DOUBLE))"
    airport = ("coalesce(`Airport_fee`, CAST(0 AS DOUBLE)) > 0"
               if "Airport_fee" in columns else "FALSE")
    return {
        "trip_duration_min": dur,                                                        # F1
        "trip_speed_mph": f"CASE WHEN {dur_h} > 0 THEN {dist} / {dur_h} END",            # F2
        "pickup_hour": f"CAST({HOUR} AS TINYINT)",                                       # F3
        "pickup_dayofweek": f"CAST({WEEKDAY} AS TINYINT)",                               # F4
        "pickup_day_name": day_name_sql(),                                               # F5
        "is_weekend": f"({WEEKDAY} >= 5)",                                               # F6
        "time_of_day": time_of_day_sql(),                                                # F7
        "is_rush_hour": rush_hour_sql(),                                                 # F8
        "fare_per_mile": f"CASE WHEN {dist} > 0 THEN {fare} / {dist} END",               # F9
        "tip_pct": f"CASE WHEN {fare} > 0 THEN CAST(100 AS DOUBLE) * `tip_amount` / {fare} END",  # F10
        "cost_per_min": f"CASE WHEN {dur} > 0 THEN `total_amount` / {dur} END",          # F11
        "is_airport_trip": f"({airport})",                                               # F12
        "pickup_date": PICKUP_DATE,                                                      # F13
    }


def feature_sql(columns: list[str]) -> list[str]:
    """The derived columns that ``columns`` does not hold yet, as ``<expr> AS <name>``."""
    return [f"{e} AS {name}" for name, e in feature_exprs(columns).items() if name not in columns]


def feature_projection(columns: list[str]) -> list[Column]:
    """The same 13 columns as ``Column`` objects."""
    return [F.expr(s) for s in feature_sql(columns)]
