"""The ``trips`` test view over the driver's ``events`` table.

The same SQL text runs in Spark (``spark.sql`` with a DataFrame argument) and
in DuckDB (the oracle), so both engines see identical input.  It plants at
least one hit for each of the 31 contract rules.  ``file_month`` stands in for
"one file per month" (H13: the month belongs to the file, not to pickup).
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.session import shared_root
from tripforge.sources.trips import land, normalise_nan, read_landed

# Fixed test-fixture definition (shared with the oracle; do not edit).
TRIPS_BASE_SQL = """SELECT event_id AS trip_id,
 CAST(CASE WHEN event_id % 503 = 0 THEN 99 WHEN event_id % 503 = 1 THEN NULL WHEN user_id % 4 = 0 THEN 1 WHEN user_id % 4 = 1 THEN 2 WHEN user_id % 4 = 2 THEN 6 ELSE 7 END AS INT) AS VendorID,
 CASE WHEN event_id % 613 = 1 THEN NULL ELSE ts END AS tpep_pickup_datetime,
 CASE WHEN event_id % 617 = 1 THEN NULL ELSE ts END + (CASE WHEN event_id % 397 = 0 THEN -600 WHEN event_id % 41 = 0 THEN 5 WHEN event_id % 89 = 0 THEN 14400 WHEN event_id % 83 = 0 THEN 0 ELSE 120 + (event_id * 37) % 4000 END) * INTERVAL '1' SECOND AS tpep_dropoff_datetime,
 CASE WHEN event_id % 21 = 0 THEN NULL WHEN event_id % 331 = 0 THEN CAST(12 AS DOUBLE) WHEN event_id % 331 = 1 THEN CAST(-1 AS DOUBLE) WHEN event_id % 113 = 0 THEN CAST(0.5 AS DOUBLE) WHEN event_id % 113 = 1 THEN CAST(2.5 AS DOUBLE) ELSE CAST(event_id % 7 AS DOUBLE) END AS passenger_count,
 CASE WHEN event_id % 509 = 0 THEN CAST(312722 AS DOUBLE) WHEN event_id % 401 = 0 THEN CAST(-1 AS DOUBLE) WHEN event_id % 401 = 1 THEN NULL WHEN event_id % 67 = 0 THEN CAST(0 AS DOUBLE) WHEN event_id % 131 = 0 THEN CAST(450 AS DOUBLE) ELSE value / 16 END AS trip_distance,
 CASE WHEN event_id % 21 = 0 THEN NULL WHEN event_id % 211 = 0 THEN CAST(8 AS DOUBLE) WHEN event_id % 31 = 0 THEN CAST(99 AS DOUBLE) ELSE CAST(1 + user_id % 6 AS DOUBLE) END AS RatecodeID,
 CASE WHEN event_id % 21 = 0 THEN NULL WHEN event_id % 223 = 0 THEN 'X' WHEN event_id % 10 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
 CAST(CASE WHEN event_id % 307 = 0 THEN 300 WHEN event_id % 307 = 1 THEN 0 WHEN event_id % 307 = 2 THEN NULL ELSE 1 + (event_id * 13) % 265 END AS INT) AS PULocationID,
 CAST(CASE WHEN event_id % 311 = 0 THEN 0 WHEN event_id % 311 = 1 THEN 300 WHEN event_id % 311 = 2 THEN NULL ELSE 1 + (event_id * 17) % 265 END AS INT) AS DOLocationID,
 CAST(CASE WHEN event_id % 313 = 0 THEN 99 WHEN event_id % 313 = 1 THEN NULL ELSE event_id % 7 END AS BIGINT) AS payment_type,
 CASE WHEN event_id % 499 = 0 THEN CAST(-999999 AS DOUBLE) WHEN event_id % 499 = 1 THEN CAST(20000 AS DOUBLE) WHEN event_id % 499 = 2 THEN NULL WHEN event_id % 53 = 0 THEN CAST(-5 AS DOUBLE) ELSE 3 + value / 4 END AS fare_amount,
 CASE WHEN event_id % 601 = 0 THEN NULL ELSE CAST(event_id % 3 AS DOUBLE) END AS extra,
 CASE WHEN event_id % 619 = 1 THEN NULL ELSE CAST(0.5 AS DOUBLE) END AS mta_tax,
 CASE WHEN event_id % 631 = 1 THEN NULL ELSE CAST(event_id % 11 AS DOUBLE) END AS tip_amount,
 CASE WHEN event_id % 641 = 1 THEN NULL WHEN event_id % 29 = 0 THEN CAST(6.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tolls_amount,
 CASE WHEN event_id % 643 = 1 THEN NULL ELSE CAST(1 AS DOUBLE) END AS improvement_surcharge,
 CASE WHEN event_id % 607 = 0 THEN CAST(20000 AS DOUBLE) WHEN event_id % 607 = 1 THEN CAST(-5000 AS DOUBLE) WHEN event_id % 607 = 2 THEN NULL ELSE 3 + value / 4 + event_id % 11 + 1.5 END AS total_amount,
 CASE WHEN event_id % 21 = 0 THEN NULL ELSE CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
 CASE WHEN event_id % 21 = 0 THEN NULL WHEN event_id % 13 = 0 THEN CAST(1.75 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Airport_fee
FROM {events}"""

# "One file per month" stand-in and the taxi type of every row.
TRIPS_SQL = (
    "SELECT b.*, CASE b.trip_id % 3 WHEN 0 THEN '2024-01' WHEN 1 THEN '2024-02' "
    "ELSE '2024-03' END AS file_month, 'yellow' AS taxi_type FROM ("
    + TRIPS_BASE_SQL + ") b"
)


def trips_sql_for_duckdb() -> str:
    return TRIPS_SQL.replace("{events}", "events")


def trips_from_events(spark: SparkSession, events: DataFrame) -> DataFrame:
    return normalise_nan(spark.sql(TRIPS_SQL, events=events))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


FIXTURE_MONTHS = ("2024-01", "2024-02", "2024-03")
FIXTURE_TAXI_TYPE = "yellow"
_LANDED: dict[str, str] = {}


def land_trips(spark: SparkSession, sf_dir: str) -> str:
    """Materialise the view as a landing zone, once per input version.

    Real trips arrive as monthly files; the fixture is landed the same way
    (Hive layout ``taxi_type=/file_month=`` under the shared checkpoint root,
    one job) so every trip query exercises the real scan (S1) instead of a
    view whose CASE expressions Catalyst would inline into all 31 rule
    predicates."""
    events_path = f"{sf_dir.rstrip('/')}/events.parquet"
    st = os.stat(events_path) if os.path.exists(events_path) else None
    tag = f"{os.path.abspath(events_path)}|{st.st_size if st else ''}|{st.st_mtime_ns if st else ''}"
    key = hashlib.sha1(tag.encode()).hexdigest()[:16]
    root = f"{shared_root(spark)}/tripforge/landing-{key}"
    if _LANDED.get(key) == root:
        return root
    from tripforge.sources.sinks import _fs_exists
    if not _fs_exists(spark, f"{root}/_SUCCESS"):
        land(trips_from_events(spark, read_table(spark, sf_dir, "events")), root)
    _LANDED[key] = root
    return root


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips fixture as a landed dataset (with taxi_type, file_month)."""
    return read_landed(spark, land_trips(spark, sf_dir))
