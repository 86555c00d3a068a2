"""Independent DuckDB statements of every catalog query (the correctness oracle).

rule objects, so a wrong Spark rule cannot hide behind a mirrored oracle.
Narrow integers are widened to INTEGER on output (H16); literals that would be
DECIMAL in DuckDB are written as ``CAST(x AS DOUBLE)``.
"""

from __future__ import annotations

from tripforge.sources.fixtures import trips_sql_for_duckdb

D = "CAST({} AS DOUBLE)".format

# (column, check, predicate that is TRUE when the row is bad), contract order.
RULES = [
    ("VendorID", "not_nullable", "VendorID IS NULL"),
    ("VendorID", "isin", "VendorID NOT IN (1, 2, 6, 7)"),
    ("tpep_pickup_datetime", "not_nullable", "tpep_pickup_datetime IS NULL"),
    ("tpep_dropoff_datetime", "not_nullable", "tpep_dropoff_datetime IS NULL"),
    ("passenger_count", "ge", "passenger_count < 0"),
    ("passenger_count", "le", "passenger_count > 9"),
    ("trip_distance", "not_nullable", "trip_distance IS NULL"),
    ("trip_distance", "ge", "trip_distance < 0"),
    ("trip_distance", "le", "trip_distance > 500"),
    ("RatecodeID", "isin", "RatecodeID NOT IN (1, 2, 3, 4, 5, 6, 99)"),
    ("store_and_fwd_flag", "isin", "store_and_fwd_flag NOT IN ('Y', 'N')"),
    ("PULocationID", "not_nullable", "PULocationID IS NULL"),
    ("PULocationID", "ge", "PULocationID < 1"),
    ("PULocationID", "le", "PULocationID > 265"),
    ("DOLocationID", "not_nullable", "DOLocationID IS NULL"),
    ("DOLocationID", "ge", "DOLocationID < 1"),
    ("DOLocationID", "le", "DOLocationID > 265"),
    ("payment_type", "not_nullable", "payment_type IS NULL"),
    ("payment_type", "isin", "payment_type NOT IN (0, 1, 2, 3, 4, 5, 6)"),
    ("fare_amount", "not_nullable", "fare_amount IS NULL"),
    ("fare_amount", "ge", "fare_amount < -1000"),
    ("fare_amount", "le", "fare_amount > 10000"),
    ("extra", "not_nullable", "extra IS NULL"),
    ("mta_tax", "not_nullable", "mta_tax IS NULL"),
    ("tip_amount", "not_nullable", "tip_amount IS NULL"),
    ("tolls_amount", "not_nullable", "tolls_amount IS NULL"),
    ("improvement_surcharge", "not_nullable", "improvement_surcharge IS NULL"),
    ("total_amount", "not_nullable", "total_amount IS NULL"),
    ("total_amount", "ge", "total_amount < -1000"),
    ("total_amount", "le", "total_amount > 10000"),
    ("tpep_dropoff_datetime", "lt_pickup", "tpep_dropoff_datetime < tpep_pickup_datetime"),
]
STRING_COLS = {"store_and_fwd_flag"}

ANY_BAD = " OR ".join(f"COALESCE({p}, FALSE)" for _, _, p in RULES)


def _value(col: str) -> str:
    if col in STRING_COLS:
        return f"COALESCE('''' || {col} || '''', 'None')"
    return f"COALESCE(CAST({col} AS VARCHAR), 'None')"


REASONS = "concat_ws('; ', " + ", ".join(
    f"CASE WHEN {p} THEN '{c}:{k}' END" if k == "lt_pickup"
    else f"CASE WHEN {p} THEN '{c}:{k}=' || {_value(c)} END"
    for c, k, p in RULES) + ")"

DUR = ("(epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) "
       f"/ {D(1000000)} / {D(60)}")

OUTLIERS = [
    ("duration_too_short", f"trip_duration_min < {D(0.5)}"),
    ("duration_too_long", f"trip_duration_min > {D(180)}"),
    ("speed_implausible", f"trip_speed_mph > {D(100)}"),
    ("non_positive_fare", f"fare_amount < {D(0.01)}"),
    ("zero_distance", "trip_distance <= 0"),
    ("too_few_passengers", "passenger_count < 1"),
]
ANY_OUTLIER = " OR ".join(f"COALESCE({p}, FALSE)" for _, p in OUTLIERS)

FEATURE_COLS = ["trip_duration_min", "trip_speed_mph", "pickup_hour", "pickup_dayofweek",
                "pickup_day_name", "is_weekend", "time_of_day", "is_rush_hour",
                "fare_per_mile", "tip_pct", "cost_per_min", "is_airport_trip", "pickup_date"]

BASE = f"""WITH trips AS ({trips_sql_for_duckdb()}),
flagged AS (SELECT *, ({ANY_BAD}) AS _bad FROM trips),
valid AS (SELECT * EXCLUDE (_bad) FROM flagged WHERE NOT _bad),
quarantined AS (SELECT * EXCLUDE (_bad), {REASONS} AS _quarantine_reasons FROM flagged WHERE _bad),
coerced AS (SELECT * REPLACE (
    CAST(TRY_CAST(VendorID AS TINYINT) AS INTEGER) AS VendorID,
    CAST(TRY_CAST(payment_type AS TINYINT) AS INTEGER) AS payment_type,
    CAST(TRY_CAST(PULocationID AS SMALLINT) AS INTEGER) AS PULocationID,
    CAST(TRY_CAST(DOLocationID AS SMALLINT) AS INTEGER) AS DOLocationID,
    CAST(TRY_CAST(round_even(RatecodeID, 0) AS SMALLINT) AS INTEGER) AS RatecodeID,
    CAST(TRY_CAST(round_even(passenger_count, 0) AS TINYINT) AS INTEGER) AS passenger_count)
  FROM valid),
dur AS (SELECT *, {DUR} AS trip_duration_min, hour(tpep_pickup_datetime) AS _h,
               isodow(tpep_pickup_datetime) - 1 AS _wd FROM coerced),
featured AS (SELECT * EXCLUDE (_h, _wd),
  CASE WHEN trip_duration_min / {D(60)} > 0 THEN trip_distance / (trip_duration_min / {D(60)}) END AS trip_speed_mph,
  CAST(_h AS INTEGER) AS pickup_hour,
  CAST(_wd AS INTEGER) AS pickup_dayofweek,
  dayname(tpep_pickup_datetime) AS pickup_day_name,
  _wd >= 5 AS is_weekend,
  CASE WHEN _h >= 0 AND _h < 6 THEN 'night' WHEN _h >= 6 AND _h < 12 THEN 'morning'
       WHEN _h >= 12 AND _h < 17 THEN 'afternoon' WHEN _h >= 17 AND _h < 21 THEN 'evening'
       WHEN _h >= 21 AND _h < 24 THEN 'night' END AS time_of_day,
  _wd < 5 AND (_h BETWEEN 7 AND 9 OR _h BETWEEN 16 AND 18) AS is_rush_hour,
  CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END AS fare_per_mile,
  CASE WHEN fare_amount > 0 THEN {D(100)} * tip_amount / fare_amount END AS tip_pct,
  CASE WHEN trip_duration_min > 0 THEN total_amount / trip_duration_min END AS cost_per_min,
  COALESCE(Airport_fee, 0) > 0 AS is_airport_trip,
  strftime(tpep_pickup_datetime, '%Y-%m-%d') AS pickup_date
  FROM dur),
flags AS (SELECT *, {", ".join(f"COALESCE({p}, FALSE) AS {n}" for n, p in OUTLIERS)} FROM featured),
features AS (SELECT * EXCLUDE ({", ".join(n for n, _ in OUTLIERS)}) FROM flags WHERE NOT ({ANY_OUTLIER})),
-- per-row status for accounting over all raw rows
status AS (SELECT t.taxi_type, t.file_month, t.trip_id, NOT f._bad AS is_valid,
                  (k.trip_id IS NOT NULL) AS is_kept
           FROM trips t JOIN flagged f USING (trip_id) LEFT JOIN features k USING (trip_id)),
months AS (SELECT taxi_type, file_month, COUNT(*) AS raw_rows,
                  COUNT(*) FILTER (WHERE is_valid) AS valid_rows,
                  COUNT(*) FILTER (WHERE is_kept) AS feature_rows
           FROM status GROUP BY taxi_type, file_month),
days AS (SELECT taxi_type, file_month, COUNT(DISTINCT pickup_date) AS n_partitions
         FROM features GROUP BY taxi_type, file_month),
acct AS (SELECT m.taxi_type, m.file_month, raw_rows, valid_rows, raw_rows - valid_rows AS quarantined_rows,
                feature_rows, valid_rows - feature_rows AS dropped_rows,
                COALESCE(n_partitions, 0) AS n_partitions,
                round({D(100)} * feature_rows / NULLIF(raw_rows, 0), 4) AS retention_pct
         FROM months m LEFT JOIN days d USING (taxi_type, file_month)),
rule_hits AS ({" UNION ALL ".join(
    f"SELECT taxi_type, file_month, {i} AS rule_no, '{c}:{k}' AS rule, '{c}' AS column_name, '{k}' AS check_name, "
    f"COUNT(*) FILTER (WHERE {p}) AS n FROM trips GROUP BY taxi_type, file_month"
    for i, (c, k, p) in enumerate(RULES, start=1))}),
drops AS ({" UNION ALL ".join(
    f"SELECT taxi_type, file_month, '{n}' AS reason, COUNT(*) FILTER (WHERE {n}) AS n FROM flags GROUP BY taxi_type, file_month"
    for n, _ in OUTLIERS)})
"""

RAW_COLS = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
            "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID",
            "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
            "improvement_surcharge", "total_amount", "congestion_surcharge", "Airport_fee"]
TRIPS_COLS = ["trip_id"] + RAW_COLS + ["file_month", "taxi_type"]
TRIPS_NUMERIC = ["trip_id", "VendorID", "passenger_count", "trip_distance", "RatecodeID",
                 "PULocationID", "DOLocationID", "payment_type", "fare_amount", "extra", "mta_tax",
                 "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
                 "congestion_surcharge", "Airport_fee"]


def _profile_nulls(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(CASE WHEN \"{c}\" IS NULL THEN {D(1)} ELSE {D(0)} END), 4) "
        f"AS null_fraction FROM {table}" for c in cols)


def _profile_numeric(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(min(\"{c}\") AS DOUBLE) AS min, CAST(max(\"{c}\") AS DOUBLE) AS max, "
        f"round(avg(CAST(\"{c}\" AS DOUBLE)), 4) AS mean, "
        f"round(quantile_cont(CAST(\"{c}\" AS DOUBLE), 0.5), 4) AS p50 FROM {table}" for c in cols)


def _profile_full(table: str, cols: list[tuple[str, str]], numeric: list[str]) -> str:
    """One row per column: ordinal, name, Spark dtype, null share, numeric stats."""
    parts = []
    for i, (c, dtype) in enumerate(cols):
        if c in numeric:
            stats = (f"CAST(min(\"{c}\") AS DOUBLE), CAST(max(\"{c}\") AS DOUBLE), "
                     f"round(avg(CAST(\"{c}\" AS DOUBLE)), 4), round(quantile_cont(CAST(\"{c}\" AS DOUBLE), 0.5), 4)")
        else:
            stats = "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT {i} AS ordinal, '{c}' AS column_name, '{dtype}' AS dtype, "
            f"round(avg(CASE WHEN \"{c}\" IS NULL THEN {D(1)} ELSE {D(0)} END), 4) AS null_fraction, "
            f"{stats} FROM {table}")
    sql = " UNION ALL ".join(parts)
    return (f"SELECT ordinal, column_name, dtype, null_fraction, col4 AS min, col5 AS max, "
            f"col6 AS mean, col7 AS p50 FROM ({sql}) AS p(ordinal, column_name, dtype, null_fraction, col4, col5, col6, col7)")


LINEITEM_COLS = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]
ORDERS_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
NUMERIC_T = ("bigint", "int", "double")

LINEITEM_RULES = [
    ("l_discount", "le", "l_discount > 0.05"),
    ("l_tax", "le", "l_tax > 0.07"),
    ("l_quantity", "le", "l_quantity > 45"),
]

EXPECTED_SCHEMA = [("VendorID", "int"), ("tpep_pickup_datetime", "timestamp_ntz"),
                   ("tpep_dropoff_datetime", "timestamp_ntz"), ("passenger_count", "double"),
                   ("trip_distance", "double"), ("RatecodeID", "double"),
                   ("store_and_fwd_flag", "string"), ("PULocationID", "int"),
                   ("DOLocationID", "int"), ("payment_type", "bigint"), ("fare_amount", "double"),
                   ("extra", "double"), ("mta_tax", "double"), ("tip_amount", "double"),
                   ("tolls_amount", "double"), ("improvement_surcharge", "double"),
                   ("total_amount", "double"), ("congestion_surcharge", "double"),
                   ("Airport_fee", "double")]

MANIFEST_VALUES = """(VALUES
  ('2023-12', 'yellow', 2900, TIMESTAMP '2024-01-05 00:00:00'),
  ('2024-01', 'yellow', 3000, TIMESTAMP '2024-02-01 00:00:00'),
  ('2024-01', 'yellow', 3334, TIMESTAMP '2024-02-02 00:00:00')) AS m(month, taxi_type, row_count, ingested_at)"""

LANDED = "SELECT taxi_type, file_month AS month, COUNT(*) AS row_count FROM trips GROUP BY taxi_type, file_month"

REQUESTED = f"""SELECT CAST(row_number() OVER (ORDER BY month) - 1 AS INTEGER) AS pos, 'yellow' AS taxi_type, month
  FROM (SELECT strftime(d, '%Y-%m') AS month FROM (
        SELECT unnest(generate_series(CAST(lo || '-01' AS DATE), CAST(hi || '-01' AS DATE), INTERVAL 1 MONTH)) AS d
        FROM (SELECT least(min(month), (SELECT min(month) FROM {MANIFEST_VALUES})) AS lo,
                     greatest(max(month), (SELECT max(month) FROM {MANIFEST_VALUES})) AS hi
              FROM ({LANDED}) l)))"""


def oracle_sql() -> dict[str, str]:
    B = BASE
    feat_cols = ", ".join(TRIPS_COLS + FEATURE_COLS)
    q: dict[str, str] = {}
    q["scan_trips"] = B + "SELECT * FROM trips"
    q["contract_violations"] = B + " UNION ALL ".join(
        f"SELECT trip_id, {i} AS rule_no, '{c}' AS column_name, '{k}' AS check_name FROM trips WHERE {p}"
        for i, (c, k, p) in enumerate(RULES, start=1))
    q["temporal_failures"] = B + ("SELECT trip_id, 'tpep_dropoff_datetime:lt_pickup' AS reason FROM trips "
                                  "WHERE tpep_dropoff_datetime < tpep_pickup_datetime")
    q["rule_hits"] = B + ("SELECT rule_no, rule, column_name, check_name, CAST(SUM(n) AS BIGINT) AS n "
                          "FROM rule_hits GROUP BY rule_no, rule, column_name, check_name")
    q["schema_drift"] = B + f"""
, actual AS (SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
        WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
        ELSE lower(column_type) END AS actual FROM (DESCRIBE SELECT * FROM trips)),
expected AS (SELECT * FROM (VALUES {", ".join(f"('{c}', '{t}')" for c, t in EXPECTED_SCHEMA)}) AS e(column_name, expected))
SELECT COALESCE(e.column_name, a.column_name) AS column_name,
       CASE WHEN a.column_name IS NULL THEN 'missing' WHEN e.column_name IS NULL THEN 'extra' ELSE 'wrong_type' END AS issue,
       e.expected AS expected, a.actual AS actual
FROM expected e FULL OUTER JOIN actual a ON e.column_name = a.column_name
WHERE a.column_name IS NULL OR e.column_name IS NULL OR e.expected <> a.actual"""
    q["reasons_tagged"] = B + "SELECT trip_id, _quarantine_reasons FROM quarantined"
    q["valid_rows"] = B + "SELECT * FROM valid"
    q["quarantine_rows"] = B + "SELECT * FROM quarantined"
    q["coerced"] = B + ("SELECT trip_id, VendorID, payment_type, PULocationID, DOLocationID, RatecodeID, "
                        "passenger_count FROM coerced")
    q["coerce_text_dates"] = B + """, txt AS (SELECT trip_id, CASE WHEN trip_id % 50 = 0 THEN 'not a date'
        ELSE CAST(tpep_pickup_datetime AS VARCHAR) END AS pickup_text FROM trips)
SELECT trip_id, TRY_CAST(pickup_text AS TIMESTAMP) AS pickup_parsed,
       (pickup_text IS NOT NULL AND TRY_CAST(pickup_text AS TIMESTAMP) IS NULL) AS parse_failed FROM txt"""
    q["features_motion"] = B + "SELECT trip_id, trip_duration_min, trip_speed_mph FROM featured"
    q["features_calendar"] = B + ("SELECT trip_id, pickup_hour, pickup_dayofweek, pickup_day_name, is_weekend, "
                                  "time_of_day, is_rush_hour, pickup_date FROM featured")
    q["features_ratios"] = B + "SELECT trip_id, fare_per_mile, tip_pct, cost_per_min, is_airport_trip FROM featured"
    q["feature_table"] = B + f"SELECT {feat_cols} FROM features"
    q["outlier_flags"] = B + ("SELECT trip_id, file_month, " + ", ".join(n for n, _ in OUTLIERS) + " FROM flags")
    q["dropped_by_reason"] = B + "SELECT file_month, reason, CAST(n AS BIGINT) AS n FROM drops"
    q["failure_counts"] = B + "SELECT file_month, rule, CAST(n AS BIGINT) AS n FROM rule_hits WHERE n > 0"
    q["validation_report"] = B + f"""SELECT taxi_type, file_month, raw_rows AS total_rows, valid_rows, quarantined_rows,
  round({D(100)} * valid_rows / NULLIF(raw_rows, 0), 4) AS valid_pct,
  round({D(100)} * quarantined_rows / NULLIF(raw_rows, 0), 4) AS quarantined_pct FROM acct"""
    q["transform_report"] = B + f"""SELECT taxi_type, file_month, valid_rows AS input_rows, feature_rows AS output_rows,
  dropped_rows, COALESCE(round({D(100)} * feature_rows / NULLIF(valid_rows, 0), 4), {D(0)}) AS output_pct,
  n_partitions, '{",".join(["trip_id"] + RAW_COLS + ["taxi_type", "file_month"] + FEATURE_COLS)}' AS feature_columns FROM acct"""
    q["partition_counts"] = B + "SELECT file_month, pickup_date, COUNT(*) AS n_rows FROM features GROUP BY file_month, pickup_date"
    q["month_overview"] = B + ("SELECT taxi_type, file_month, COALESCE(raw_rows, 0) AS raw_rows, valid_rows, feature_rows, "
                               "retention_pct FROM acct")
    q["run_totals"] = B + f"""SELECT COUNT(*) AS months_processed, CAST(COALESCE(SUM(raw_rows), 0) AS BIGINT) AS raw_rows,
  CAST(COALESCE(SUM(feature_rows), 0) AS BIGINT) AS feature_rows,
  round({D(100)} * SUM(feature_rows) / NULLIF(SUM(raw_rows), 0), 4) AS overall_retention_pct FROM acct"""
    q["pipeline_end_to_end"] = B + "SELECT * FROM acct"
    q["top_quarantine_reasons"] = B + """SELECT file_month, rule, CAST(n AS BIGINT) AS n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT file_month, rule, n, row_number() OVER (PARTITION BY file_month ORDER BY n DESC, rule ASC) AS rank
  FROM rule_hits WHERE n > 0) WHERE rank <= 5"""
    q["top_outlier_reasons"] = B + """SELECT file_month, reason, CAST(n AS BIGINT) AS n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT file_month, reason, n, row_number() OVER (PARTITION BY file_month ORDER BY n DESC, reason ASC) AS rank
  FROM drops WHERE n > 0) WHERE rank <= 5"""
    fcols = ", ".join(f"'{c}'" for c in ["trip_id"] + RAW_COLS + ["taxi_type", "file_month"] + FEATURE_COLS)
    q["run_summary"] = B + f""", fc AS (SELECT file_month, map_from_entries(list(struct_pack(k := rule, v := CAST(n AS BIGINT)) ORDER BY rule)) AS failure_counts
             FROM rule_hits WHERE n > 0 GROUP BY file_month),
dr AS (SELECT file_month, map_from_entries(list(struct_pack(k := reason, v := CAST(n AS BIGINT)) ORDER BY reason)) AS dropped_by_reason
       FROM drops GROUP BY file_month),
mm AS (SELECT a.*, fc.failure_counts, dr.dropped_by_reason FROM acct a LEFT JOIN fc USING (file_month) LEFT JOIN dr USING (file_month))
SELECT COUNT(*) AS months_processed, CAST(SUM(raw_rows) AS BIGINT) AS raw_rows, CAST(SUM(feature_rows) AS BIGINT) AS feature_rows,
  CAST(to_json(struct_pack(
    months_processed := COUNT(*),
    totals := struct_pack(raw_rows := CAST(SUM(raw_rows) AS BIGINT), feature_rows := CAST(SUM(feature_rows) AS BIGINT),
                          overall_retention_pct := round({D(100)} * SUM(feature_rows) / NULLIF(SUM(raw_rows), 0), 4)),
    months := list(struct_pack(
        month := file_month, taxi_type := taxi_type, raw_rows := raw_rows, valid_rows := valid_rows,
        feature_rows := feature_rows, end_to_end_retention_pct := retention_pct,
        validation := struct_pack(total_rows := raw_rows, valid_rows := valid_rows, quarantined_rows := quarantined_rows,
            valid_pct := round({D(100)} * valid_rows / NULLIF(raw_rows, 0), 4),
            quarantined_pct := round({D(100)} * quarantined_rows / NULLIF(raw_rows, 0), 4),
            failure_counts := failure_counts),
        transform := struct_pack(input_rows := valid_rows, output_rows := feature_rows, dropped_rows := dropped_rows,
            output_pct := COALESCE(round({D(100)} * feature_rows / NULLIF(valid_rows, 0), 4), {D(0)}),
            dropped_by_reason := dropped_by_reason, feature_columns := [{fcols}], n_partitions := n_partitions))
      ORDER BY file_month))) AS VARCHAR) AS summary_json
FROM mm"""
    q["dq_digest"] = B + f"""SELECT taxi_type, file_month, 'validation' AS section, item, CAST(value AS DOUBLE) AS value FROM (
    SELECT taxi_type, file_month, 'total_rows' AS item, raw_rows AS value FROM acct
    UNION ALL SELECT taxi_type, file_month, 'valid_rows', valid_rows FROM acct
    UNION ALL SELECT taxi_type, file_month, 'quarantined_rows', quarantined_rows FROM acct
    UNION ALL SELECT taxi_type, file_month, 'valid_pct', round({D(100)} * valid_rows / NULLIF(raw_rows, 0), 2) FROM acct
    UNION ALL SELECT taxi_type, file_month, 'quarantined_pct', round({D(100)} * quarantined_rows / NULLIF(raw_rows, 0), 2) FROM acct)
UNION ALL SELECT taxi_type, file_month, 'top_quarantine_reason', rule, CAST(n AS DOUBLE) FROM (
    SELECT taxi_type, file_month, rule, n, row_number() OVER (PARTITION BY taxi_type, file_month ORDER BY n DESC, rule) AS rk
    FROM rule_hits WHERE n > 0) WHERE rk <= 5
UNION ALL SELECT taxi_type, file_month, 'transform', item, CAST(value AS DOUBLE) FROM (
    SELECT taxi_type, file_month, 'input_rows' AS item, valid_rows AS value FROM acct
    UNION ALL SELECT taxi_type, file_month, 'output_rows', feature_rows FROM acct
    UNION ALL SELECT taxi_type, file_month, 'dropped_rows', dropped_rows FROM acct
    UNION ALL SELECT taxi_type, file_month, 'output_pct', COALESCE(round({D(100)} * feature_rows / NULLIF(valid_rows, 0), 2), 0) FROM acct
    UNION ALL SELECT taxi_type, file_month, 'n_partitions', n_partitions FROM acct)
UNION ALL SELECT taxi_type, file_month, 'top_outlier_reason', reason, CAST(n AS DOUBLE) FROM (
    SELECT taxi_type, file_month, reason, n, row_number() OVER (PARTITION BY taxi_type, file_month ORDER BY n DESC, reason) AS rk
    FROM drops WHERE n > 0) WHERE rk <= 5
UNION ALL SELECT taxi_type, file_month, 'retention', 'retention_pct', round({D(100)} * feature_rows / NULLIF(raw_rows, 0), 2)
    FROM acct WHERE raw_rows > 0"""
    q["month_range"] = B + """SELECT CAST(row_number() OVER (ORDER BY month) - 1 AS INTEGER) AS pos, month FROM (
  SELECT strftime(unnest(generate_series(CAST(lo || '-01' AS DATE), CAST(hi || '-01' AS DATE), INTERVAL 1 MONTH)), '%Y-%m') AS month
  FROM (SELECT least(min(file_month), min(strftime(tpep_pickup_datetime, '%Y-%m'))) AS lo,
               greatest(max(file_month), max(strftime(tpep_pickup_datetime, '%Y-%m'))) AS hi FROM trips))"""
    q["file_stats"] = " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file_name, (SELECT COUNT(*) FROM {t}) AS row_count, "
        f"(SELECT string_agg(column_name, ',') FROM (DESCRIBE {t})) AS columns" for t in ("events", "lineitem", "orders"))
    q["manifest_pending"] = B + f"""SELECT l.taxi_type, l.month, l.row_count FROM ({LANDED}) l
  WHERE NOT EXISTS (SELECT 1 FROM {MANIFEST_VALUES} WHERE m.taxi_type = l.taxi_type AND m.month = l.month)"""
    q["manifest_latest"] = B + f""", hist AS (SELECT month, taxi_type, CAST(row_count AS BIGINT) AS row_count, ingested_at FROM {MANIFEST_VALUES}),
new AS (SELECT l.month, l.taxi_type, l.row_count, TIMESTAMP '2024-04-01 00:00:00' AS ingested_at FROM ({LANDED}) l
        WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.taxi_type = l.taxi_type AND h.month = l.month)),
allrec AS (SELECT * FROM hist UNION ALL SELECT * FROM new)
SELECT taxi_type, month, arg_max(row_count, ingested_at) AS row_count, max(ingested_at) AS ingested_at
FROM allrec GROUP BY taxi_type, month"""
    q["ingest_totals"] = B + f""", req AS ({REQUESTED}),
plan AS (SELECT r.pos, r.month, l.row_count, (l.row_count IS NOT NULL) AS landed,
           (l.row_count IS NOT NULL AND EXISTS (SELECT 1 FROM {MANIFEST_VALUES} WHERE m.month = r.month AND m.taxi_type = r.taxi_type)) AS skipped
         FROM req r LEFT JOIN ({LANDED}) l ON l.month = r.month AND l.taxi_type = r.taxi_type)
SELECT COUNT(*) AS requested, COUNT(*) FILTER (WHERE landed AND NOT skipped) AS loaded,
       COUNT(*) FILTER (WHERE skipped) AS skipped, COUNT(*) FILTER (WHERE NOT landed) AS missing,
       CAST(COALESCE(SUM(row_count), 0) AS BIGINT) AS total_rows, {D(0)} AS total_mb FROM plan"""
    q["month_availability"] = B + f""", req AS ({REQUESTED})
SELECT r.pos, r.taxi_type, r.month, CASE WHEN l.row_count IS NOT NULL THEN 'ok' ELSE 'missing' END AS status, l.row_count
FROM req r LEFT JOIN ({LANDED}) l ON l.month = r.month AND l.taxi_type = r.taxi_type"""
    q["sink_valid_roundtrip"] = B + "SELECT * FROM valid"
    q["sink_quarantine_roundtrip"] = B + "SELECT * FROM quarantined"
    q["sink_partitioned_roundtrip"] = B + f"SELECT {feat_cols} FROM features"
    q["snapshot_features"] = B + f"SELECT {feat_cols} FROM features WHERE file_month <> '2024-02' OR trip_id % 2 = 0"
    q["snapshot_before"] = q["sink_quarantine_roundtrip"]
    q["report_json_roundtrip"] = q["validation_report"]
    # a run's own reports list the columns of the table that it wrote: partitions last
    stored = ["trip_id"] + RAW_COLS + [c for c in FEATURE_COLS if c != "pickup_date"] + ["taxi_type", "file_month", "pickup_date"]
    listed = ["trip_id"] + RAW_COLS + ["taxi_type", "file_month"] + FEATURE_COLS
    q["report_transform_roundtrip"] = q["transform_report"].replace(",".join(listed), ",".join(stored))
    q["report_summary_roundtrip"] = q["run_summary"].replace(fcols, ", ".join(f"'{c}'" for c in stored))
    q["report_digest_roundtrip"] = q["dq_digest"]
    q["stored_run_totals"] = q["run_totals"]
    q["head_sample"] = B + "SELECT * FROM trips ORDER BY trip_id LIMIT 100"
    q["profile_dtypes"] = B + """, d AS (SELECT column_name, column_type,
        row_number() OVER () - 1 AS pos
      FROM (DESCRIBE SELECT * EXCLUDE (taxi_type, file_month), taxi_type, file_month FROM trips))
SELECT (SELECT COUNT(*) FROM trips) AS rows, CAST(pos AS INTEGER) AS ordinal, column_name,
  CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
       WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS dtype
FROM d"""
    q["profile_nulls"] = B + _profile_nulls("trips", TRIPS_COLS)
    q["profile_numeric"] = B + _profile_numeric("trips", TRIPS_NUMERIC)
    q["contract_customer"] = """SELECT c_custkey, concat_ws('; ',
    CASE WHEN c_acctbal < 0 THEN 'c_acctbal:ge=' || COALESCE(CAST(c_acctbal AS VARCHAR), 'None') END,
    CASE WHEN c_mktsegment IS NULL THEN 'c_mktsegment:not_nullable=None' END) AS _quarantine_reasons
  FROM customer WHERE COALESCE(c_acctbal < 0, FALSE) OR c_mktsegment IS NULL"""
    q["contract_lineitem_orders"] = """SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate,
    'l_shipdate:lt_orderdate' AS _quarantine_reasons
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate"""
    q["failure_counts_lineitem"] = " UNION ALL ".join(
        f"SELECT l_returnflag, '{c}:{k}' AS rule, COUNT(*) AS n FROM lineitem WHERE {p} GROUP BY l_returnflag"
        for c, k, p in LINEITEM_RULES)
    num_l = [c for c, t in LINEITEM_COLS if t in NUMERIC_T]
    num_o = [c for c, t in ORDERS_COLS if t in NUMERIC_T]
    q["profile_lineitem"] = _profile_full("lineitem", LINEITEM_COLS, num_l)
    q["profile_orders"] = _profile_full("orders", ORDERS_COLS, num_o)
    q["partition_counts_orders"] = ("SELECT strftime(o_orderdate, '%Y-%m') AS order_month, COUNT(*) AS n_rows, "
                                    "COUNT(DISTINCT strftime(o_orderdate, '%Y-%m-%d')) AS n_days FROM orders "
                                    "GROUP BY strftime(o_orderdate, '%Y-%m')")
    q["top_reasons_by_flag"] = ("SELECT l_returnflag, rule, n, CAST(rank AS INTEGER) AS rank FROM ("
                                "SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, rule) AS rank FROM ("
                                + q["failure_counts_lineitem"] + ") WHERE n > 0) WHERE rank <= 2")
    q["report_profile_roundtrip"] = q["profile_orders"]
    return q
