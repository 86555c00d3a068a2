"""Outlier predicates (O1-O6) over a coerced, featured frame.

Each predicate may be NULL (e.g. speed undefined, passenger count missing);
NULL never drops a row and is never counted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripforge.config import DEFAULT_THRESHOLDS, Thresholds


def _d(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def outlier_sql(t: Thresholds = DEFAULT_THRESHOLDS) -> list[tuple[str, str]]:
    return [
        ("duration_too_short", f"(`trip_duration_min` < {_d(t.min_trip_duration_min)})"),   # O1
        ("duration_too_long", f"(`trip_duration_min` > {_d(t.max_trip_duration_min)})"),    # O2
        ("speed_implausible", f"(`trip_speed_mph` > {_d(t.max_trip_speed_mph)})"),           # O3
        ("non_positive_fare", f"(`fare_amount` < {_d(t.min_fare_amount)})"),                 # O4
        ("zero_distance", "(`trip_distance` <= 0)"),                                         # O5
        # O6 sees the coerced (rounded) passenger count.
        ("too_few_passengers", f"(`passenger_count` < {_d(t.min_passenger_count)})"),        # O6
    ]


def any_outlier_sql(t: Thresholds = DEFAULT_THRESHOLDS) -> str:
    return "(" + " OR ".join(f"coalesce({p}, FALSE)" for _, p in outlier_sql(t)) + ")"


def outlier_rules(t: Thresholds = DEFAULT_THRESHOLDS) -> list[tuple[str, Column]]:
    return [(name, F.expr(p)) for name, p in outlier_sql(t)]
