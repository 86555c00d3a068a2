"""Every operator of the inventory as a named query (spark, sf_dir) -> DataFrame.

Trip queries run on the ``trips`` view derived from the ``events`` table
(see ``sources/fixtures.py``); the generic-operator queries run the same
contract / profile / report operators on lineitem, orders and customer.
Sink queries write to a fresh directory under the session's shared
checkpoint root and return what they read back.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.functions import rules as R
from tripforge.functions.coerce import parse_datetime
from tripforge.functions.contract import DROPOFF, PICKUP, Contract
from tripforge.operators import profile as P
from tripforge.operators import quarantine as Q
from tripforge.operators import reports as RP
from tripforge.operators import transform as X
from tripforge.plans import accounting as A
from tripforge.session import apply_engine_conf, scratch_path
from tripforge.sources import landing as L
from tripforge.sources import sinks as S
from tripforge.sources import snapshots as V
from tripforge.sources.fixtures import read_table, trips

Query = Callable[[SparkSession, str], DataFrame]


def widen(df: DataFrame) -> DataFrame:
    """Narrow ints (tinyint/smallint) as INT for cross-engine comparison."""
    return df.selectExpr(*[
        f"CAST({R.ident(f.name)} AS INT) AS {R.ident(f.name)}"
        if isinstance(f.dataType, (T.ByteType, T.ShortType)) else R.ident(f.name)
        for f in df.schema.fields])


def _trips(spark: SparkSession, sf: str) -> DataFrame:
    apply_engine_conf(spark)
    return trips(spark, sf)


def _valid(spark, sf):
    return Q.valid_rows(_trips(spark, sf))


def _featured(spark, sf):
    return X.featured(_valid(spark, sf))


def _features(spark, sf):
    return X.build_features(_valid(spark, sf))


def _stats(spark, sf) -> A.PipelineStats:
    return A.pipeline_stats(_trips(spark, sf))


def _feature_columns(spark, sf) -> list[str]:
    return _features(spark, sf).columns


# -- manifest / landing fixtures -------------------------------------------------
# A recorded manifest history (fixed test state): 2023-12 recorded but its
# file is gone; 2024-01 recorded twice, the later recording wins.
MANIFEST_HISTORY = [
    ("2023-12", "yellow", 2900, "2024-01-05 00:00:00"),
    ("2024-01", "yellow", 3000, "2024-02-01 00:00:00"),
    ("2024-01", "yellow", 3334, "2024-02-02 00:00:00"),
]
RECORDED_AT = "2024-04-01 00:00:00"


def _manifest(spark: SparkSession) -> DataFrame:
    rows = [(m, t, f"raw/{t}_tripdata_{m}.parquet", None, n, None, ts)
            for m, t, n, ts in MANIFEST_HISTORY]
    df = spark.createDataFrame(
        rows, "month string, taxi_type string, file string, size_bytes bigint, row_count bigint, "
              "columns array<string>, ingested_at string")
    return df.withColumn("ingested_at", F.to_timestamp_ntz("ingested_at"))


def _landed(spark, sf) -> DataFrame:
    """Landed months with their row counts (the trips view stands in for files)."""
    return (_trips(spark, sf).groupBy("taxi_type", F.col("file_month").alias("month"))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .withColumn("size_bytes", F.lit(None).cast("long")))


def _requested(spark, sf) -> DataFrame:
    """Every month from the earliest known (manifest or landed) to the latest."""
    known = (_landed(spark, sf).select("month")
             .unionByName(_manifest(spark).select("month")))
    return L.months_spanned(known, ["month"]).withColumn("taxi_type", F.lit("yellow"))


# -- sinks: one pipeline run per (session, sf_dir), reused by the round-trips --------
_RUNS: dict[tuple[int, str], object] = {}


def _pipeline_run(spark: SparkSession, sf: str):
    from tripforge.plans.pipeline import run_months
    key = (id(spark), sf)
    if key not in _RUNS:
        raw = _trips(spark, sf)
        months = [("yellow", m) for m in ("2024-01", "2024-02", "2024-03")]
        _RUNS[key] = run_months(spark, raw, scratch_path(spark, "pipeline"), months)
    return _RUNS[key]


def q_sink_valid_roundtrip(spark, sf):
    r = _pipeline_run(spark, sf)
    return S.read_valid(spark, r.validated_root)


def q_sink_quarantine_roundtrip(spark, sf):
    r = _pipeline_run(spark, sf)
    return S.read_quarantine_table(spark, r.quarantine_root)


def q_sink_partitioned_roundtrip(spark, sf):
    r = _pipeline_run(spark, sf)
    # rerun the feature stage into the same root: each day partition is
    # replaced at commit (dynamic overwrite), never appended to
    from tripforge.plans.pipeline import transform_stage
    months = [("yellow", m) for m in ("2024-01", "2024-02", "2024-03")]
    transform_stage(spark, r.validated_root, r.features_root, months)
    return widen(S.read_features(spark, r.features_root))


REPORT_SCHEMA = T.StructType([
    T.StructField("taxi_type", T.StringType()), T.StructField("file_month", T.StringType()),
    T.StructField("total_rows", T.LongType()), T.StructField("valid_rows", T.LongType()),
    T.StructField("quarantined_rows", T.LongType()), T.StructField("valid_pct", T.DoubleType()),
    T.StructField("quarantined_pct", T.DoubleType()),
])


def q_report_json_roundtrip(spark, sf):
    r = _pipeline_run(spark, sf)
    path = f"{r.out_root}/reports/validation/run_id={r.run_id}"
    return S.read_report(spark, path, REPORT_SCHEMA)


TRANSFORM_SCHEMA = ("taxi_type string, file_month string, input_rows bigint, output_rows bigint, dropped_rows bigint, "
                    "output_pct double, feature_columns array<string>, n_partitions bigint")
SUMMARY_SCHEMA = "months_processed bigint, raw_rows bigint, feature_rows bigint, summary_json string"


def q_report_transform_roundtrip(spark, sf):
    r = _pipeline_run(spark, sf)
    report = S.read_report(spark, f"{r.out_root}/reports/transform/run_id={r.run_id}", TRANSFORM_SCHEMA)
    return report.withColumn("feature_columns", F.array_join("feature_columns", ","))


def q_report_summary_roundtrip(spark, sf):
    r = _pipeline_run(spark, sf)
    return S.read_report(spark, f"{r.out_root}/reports/run_summary/run_id={r.run_id}", SUMMARY_SCHEMA)


def _stored_json(report: DataFrame, name: str) -> DataFrame:
    """A report written as JSON and read back with the types it had."""
    path = scratch_path(report.sparkSession, name)
    S.write_report(report, path)
    return S.read_report(report.sparkSession, path, report.schema)


def q_stored_run_totals(spark, sf):
    from tripforge.plans.pipeline import stored_totals
    return stored_totals(spark, _pipeline_run(spark, sf).out_root)


def _snapshots(spark, sf) -> tuple[str, int, int]:
    """Three months published, then the second anew without its odd trips:
    (root, version before, version after)."""
    from tripforge.plans.pipeline import publish_months
    key = (id(spark), sf, "snapshots")
    if key not in _RUNS:
        root, raw = scratch_path(spark, "snapshots"), _trips(spark, sf)
        _, first = publish_months(spark, raw, root, [("yellow", f"2024-0{m}") for m in (1, 2, 3)])
        _, second = publish_months(spark, raw.filter("trip_id % 2 = 0"), root, [("yellow", "2024-02")])
        _RUNS[key] = (root, first.version, second.version)
    return _RUNS[key]


def q_snapshot_features(spark, sf):
    root, _, now = _snapshots(spark, sf)
    return widen(V.read(spark, root, "features", now))


def q_snapshot_before(spark, sf):
    root, before, _ = _snapshots(spark, sf)
    return V.read(spark, root, "quarantine", before)


# -- generic operators on the other tables -------------------------------------------
CUSTOMER_CONTRACT = Contract(rules=(R.ge("c_acctbal", 0), R.not_nullable("c_mktsegment")))
LINEITEM_ORDERS_CONTRACT = Contract(rules=(R.before("l_shipdate", "o_orderdate", "lt_orderdate"),))
LINEITEM_CONTRACT = Contract(rules=(R.le("l_discount", 0.05), R.le("l_tax", 0.07), R.le("l_quantity", 45)))


def q_contract_customer(spark, sf):
    c = read_table(spark, sf, "customer")
    return Q.quarantine_rows(c, CUSTOMER_CONTRACT).select("c_custkey", Q.REASONS_COL)


def q_contract_lineitem_orders(spark, sf):
    # A plain equi-join on the order key: Spark broadcasts a side only under its
    # own threshold, and AQE corrects the choice and splits skewed keys.
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    od = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey).drop("o_orderkey")
    return Q.quarantine_rows(j, LINEITEM_ORDERS_CONTRACT)


def q_failure_counts_lineitem(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return Q.failure_counts(li, ["l_returnflag"], LINEITEM_CONTRACT)


def q_top_reasons_by_flag(spark, sf):
    return RP.top_reasons(q_failure_counts_lineitem(spark, sf), ["l_returnflag"], "rule", k=2)


def q_partition_counts_orders(spark, sf):
    o = read_table(spark, sf, "orders")
    per_day = (o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("order_month"),
                         F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
               .agg(F.count(F.lit(1)).alias("n")))
    return per_day.groupBy("order_month").agg(F.sum("n").alias("n_rows"),
                                              F.count(F.lit(1)).alias("n_days"))


def _file_stats(spark, sf):
    paths = [f"{sf.rstrip('/')}/{t}.parquet" for t in ("events", "lineitem", "orders")]
    return L.file_stats(spark, paths).select("file_name", "row_count", F.array_join("columns", ",").alias("columns"))


def _text_dates(spark, sf):
    t = _trips(spark, sf)
    txt = F.when(F.col("trip_id") % 50 == 0, F.lit("not a date")).otherwise(
        F.col(PICKUP).cast("string"))
    parsed = parse_datetime(F.col("pickup_text"), T.StringType())
    return (t.select("trip_id", txt.alias("pickup_text"))
             .select("trip_id", parsed.alias("pickup_parsed"),
                     (F.col("pickup_text").isNotNull() & parsed.isNull()).alias("parse_failed")))


def _manifest_latest(spark, sf):
    hist = _manifest(spark)
    new = (L.pending(_landed(spark, sf), hist)
           .select("month", "taxi_type", F.lit(None).cast("string").alias("file"), "size_bytes",
                   "row_count", F.lit(None).cast("array<string>").alias("columns"),
                   F.to_timestamp_ntz(F.lit(RECORDED_AT)).alias("ingested_at")))
    return L.manifest_latest(hist.unionByName(new)).select("taxi_type", "month", "row_count", "ingested_at")


def _months_spanned(spark, sf):
    t = _trips(spark, sf).select("file_month", F.date_format(PICKUP, "yyyy-MM").alias("pm"))
    return L.months_spanned(t, ["file_month", "pm"])


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # sources / scans
        "scan_trips": lambda s, sf: _trips(s, sf),
        "file_stats": _file_stats,
        "manifest_pending": lambda s, sf: L.pending(_landed(s, sf), _manifest(s))
                                           .select("taxi_type", "month", "row_count"),
        "manifest_latest": _manifest_latest,
        "ingest_totals": lambda s, sf: L.ingest_totals(
            L.ingest_plan(_requested(s, sf), _landed(s, sf), _manifest(s))),
        "month_range": _months_spanned,
        "month_availability": lambda s, sf: L.availability(_requested(s, sf), _landed(s, sf)),
        "head_sample": lambda s, sf: P.head_sample(_trips(s, sf), 100, ["trip_id"]),
        # contract
        "contract_violations": lambda s, sf: Q.violations(_trips(s, sf), ["trip_id"]),
        "temporal_failures": lambda s, sf: Q.quarantine_rows(
            _trips(s, sf), Contract(rules=(R.before(DROPOFF, PICKUP, "lt_pickup"),)))
            .select("trip_id", F.col(Q.REASONS_COL).alias("reason")),
        "rule_hits": lambda s, sf: Q.rule_hits(_trips(s, sf)),
        "schema_drift": lambda s, sf: Q.schema_drift(_trips(s, sf)),
        "reasons_tagged": lambda s, sf: Q.quarantine_rows(_trips(s, sf)).select("trip_id", Q.REASONS_COL),
        "valid_rows": _valid,
        "quarantine_rows": lambda s, sf: Q.quarantine_rows(_trips(s, sf)),
        # coercion and features
        "coerced": lambda s, sf: widen(X.coerce_types(_valid(s, sf))).select(
            "trip_id", "VendorID", "payment_type", "PULocationID", "DOLocationID",
            "RatecodeID", "passenger_count"),
        "coerce_text_dates": _text_dates,
        "features_motion": lambda s, sf: _featured(s, sf).select(
            "trip_id", "trip_duration_min", "trip_speed_mph"),
        "features_calendar": lambda s, sf: widen(_featured(s, sf).select(
            "trip_id", "pickup_hour", "pickup_dayofweek", "pickup_day_name", "is_weekend",
            "time_of_day", "is_rush_hour", "pickup_date")),
        "features_ratios": lambda s, sf: _featured(s, sf).select(
            "trip_id", "fare_per_mile", "tip_pct", "cost_per_min", "is_airport_trip"),
        "feature_table": lambda s, sf: widen(_features(s, sf)),
        # outliers
        "outlier_flags": lambda s, sf: X.outlier_flags(_featured(s, sf), keep=["trip_id", "file_month"]),
        "dropped_by_reason": lambda s, sf: X.dropped_by_reason(_featured(s, sf), ["file_month"]),
        # aggregates and reports
        "failure_counts": lambda s, sf: Q.failure_counts(_trips(s, sf), ["file_month"]),
        "validation_report": lambda s, sf: RP.validation_report(A.month_accounting(_trips(s, sf))),
        "transform_report": lambda s, sf: RP.transform_report(
            A.month_accounting(_trips(s, sf)), _feature_columns(s, sf))
            .withColumn("feature_columns", F.array_join("feature_columns", ",")),
        "partition_counts": lambda s, sf: _features(s, sf).groupBy("file_month", "pickup_date")
            .agg(F.count(F.lit(1)).alias("n_rows")),
        "month_overview": lambda s, sf: RP.month_overview(A.month_accounting(_trips(s, sf))),
        "run_totals": lambda s, sf: RP.run_totals(A.month_accounting(_trips(s, sf))),
        "pipeline_end_to_end": lambda s, sf: A.month_accounting(_trips(s, sf)),
        "top_quarantine_reasons": lambda s, sf: RP.top_reasons(
            Q.failure_counts(_trips(s, sf), ["file_month"]), ["file_month"], "rule"),
        "top_outlier_reasons": lambda s, sf: RP.top_reasons(
            X.dropped_by_reason(_featured(s, sf), ["file_month"]), ["file_month"], "reason"),
        "run_summary": lambda s, sf: (lambda st: RP.run_summary(
            st.months(), st.failures, st.drops, _feature_columns(s, sf)))(_stats(s, sf)),
        "dq_digest": lambda s, sf: (lambda st: RP.dq_digest(
            st.months(), st.failures, st.drops))(_stats(s, sf)),
        # sinks
        "sink_valid_roundtrip": q_sink_valid_roundtrip,
        "sink_quarantine_roundtrip": q_sink_quarantine_roundtrip,
        "sink_partitioned_roundtrip": q_sink_partitioned_roundtrip,
        "report_json_roundtrip": q_report_json_roundtrip,
        "report_transform_roundtrip": q_report_transform_roundtrip,
        "report_summary_roundtrip": q_report_summary_roundtrip,
        "report_digest_roundtrip": lambda s, sf: (lambda st: _stored_json(RP.dq_digest(
            st.months(), st.failures, st.drops), "digest"))(_stats(s, sf)),
        "report_profile_roundtrip": lambda s, sf: _stored_json(P.profile(read_table(s, sf, "orders")), "profile"),
        "stored_run_totals": q_stored_run_totals,
        "snapshot_features": q_snapshot_features,
        "snapshot_before": q_snapshot_before,
        # profile
        "profile_dtypes": lambda s, sf: P.dtypes(_trips(s, sf)),
        "profile_nulls": lambda s, sf: P.null_fractions(_trips(s, sf)),
        "profile_numeric": lambda s, sf: P.numeric_stats(_trips(s, sf)),
        # same operators on the other tables
        "contract_customer": q_contract_customer,
        "contract_lineitem_orders": q_contract_lineitem_orders,
        "failure_counts_lineitem": q_failure_counts_lineitem,
        "profile_lineitem": lambda s, sf: P.profile(read_table(s, sf, "lineitem")),
        "profile_orders": lambda s, sf: P.profile(read_table(s, sf, "orders")),
        "partition_counts_orders": q_partition_counts_orders,
        "top_reasons_by_flag": q_top_reasons_by_flag,
    }
    return {name: _with_engine_conf(fn) for name, fn in q.items()}


def _with_engine_conf(fn: Query) -> Query:
    """Every query runs with the engine's SQL settings on the caller's session."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_engine_conf(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run
