"""End-to-end runs, layout, idempotence, accounting."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF01, trip
from tripforge.plans.accounting import month_accounting, pipeline_stats
from tripforge.functions.contract import RAW_TRIP_SCHEMA
from tripforge.plans.pipeline import run_files, run_months
from tripforge.sources import sinks as S
from tripforge.sources.fixtures import trips
from tripforge.sources.trips import read_trips
from tripforge.session import local_path

MONTHS = [("yellow", "2024-01"), ("yellow", "2024-02"), ("yellow", "2024-03")]


@pytest.fixture(scope="module")
def fixture_run(spark):
    from tripforge.session import scratch_path
    return run_months(spark, trips(spark, SF01), scratch_path(spark, "pipe"), MONTHS)


def test_known_month_accounting(fixture_run):
    got = {r.file_month: (r.raw_rows, r.valid_rows, r.feature_rows, r.retention_pct)
           for r in fixture_run.months.collect()}
    assert got == {"2024-01": (3334, 3093, 2773, 83.1734),
                   "2024-02": (3333, 3085, 2376, 71.2871),
                   "2024-03": (3333, 3084, 2364, 70.9271)}


def test_outputs_match_lazy_plan(spark, fixture_run):
    lazy = {r.file_month: tuple(r) for r in month_accounting(trips(spark, SF01)).collect()}
    done = {r.file_month: tuple(r) for r in fixture_run.months.collect()}
    assert lazy == done


def test_sinks_roundtrip_counts(spark, fixture_run):
    assert S.read_valid(spark, fixture_run.validated_root).count() == 9262
    q = S.read_quarantine_table(spark, fixture_run.quarantine_root)
    assert q.count() == 738 and S.REASONS_COL in q.columns
    assert S.read_quarantine(spark, fixture_run.validated_root).count() == 0   # compacted away
    assert S.REASONS_COL not in S.read_valid(spark, fixture_run.validated_root).columns
    feats = S.read_features(spark, fixture_run.features_root)
    assert feats.count() == 7513
    assert dict(feats.dtypes)["pickup_date"] == "string"          # H12


def test_day_partition_layout(fixture_run):
    root = local_path(fixture_run.features_root)
    month_dir = os.path.join(root, "taxi_type=yellow", "file_month=2024-01")
    days = sorted(d for d in os.listdir(month_dir) if d.startswith("pickup_date="))
    assert days[0] == "pickup_date=2024-01-01" and len(days) == 30


def test_reports_written(spark, fixture_run):
    rep = f"{fixture_run.out_root}/reports"
    v = spark.read.json(f"{rep}/validation/run_id={fixture_run.run_id}")
    assert v.count() == 3
    s = spark.read.text(f"{rep}/run_summary/run_id={fixture_run.run_id}").collect()
    assert '"months_processed":3' in s[0][0]


def test_failure_and_drop_stats_match_lazy(spark, fixture_run):
    st = pipeline_stats(trips(spark, SF01))
    lazy_f = {(r.file_month, r.rule, r.n) for r in st.failures.filter("n > 0").collect()}
    done_f = {(r.file_month, r.rule, r.n) for r in fixture_run.failures.collect()}
    assert lazy_f == done_f
    lazy_d = {(r.file_month, r.reason, r.n) for r in st.drops.collect()}
    done_d = {(r.file_month, r.reason, r.n) for r in fixture_run.drops.collect()}
    assert lazy_d == done_d


def test_rerun_replaces_and_clears_stale_quarantine(spark, make_trips, tmp_out):
    bad = make_trips(trip(), trip(VendorID=99), month="2024-01")
    run_months(spark, bad, tmp_out, [("yellow", "2024-01")], write_reports=False)
    assert S.read_quarantine_table(spark, f"{tmp_out}/quarantine").count() == 1
    good = make_trips(trip(), trip(), month="2024-01")
    r = run_months(spark, good, tmp_out, [("yellow", "2024-01")], write_reports=False)
    q_schema = S.quarantine_schema(S.validated_schema(good.schema))
    assert S.read_quarantine_table(spark, f"{tmp_out}/quarantine", q_schema).count() == 0   # H11
    assert S.read_valid(spark, f"{tmp_out}/validated").count() == 2     # replaced, not appended
    assert S.read_features(spark, f"{tmp_out}/features").count() == 2
    assert r.months.collect()[0].feature_rows == 2


def test_other_months_untouched(spark, make_trips, tmp_out):
    run_months(spark, make_trips(trip(), month="2024-01"), tmp_out, [("yellow", "2024-01")],
               write_reports=False)
    run_months(spark, make_trips(trip(), trip(), month="2024-02"), tmp_out, [("yellow", "2024-02")],
               write_reports=False)
    got = {r.file_month: r["count"] for r in
           S.read_valid(spark, f"{tmp_out}/validated").groupBy("file_month").count().collect()}
    assert got == {"2024-01": 1, "2024-02": 2}


def test_out_of_month_pickups_kept(spark, make_trips, tmp_out):
    p = dt.datetime(2024, 2, 1, 0, 5)
    rows = make_trips(trip(), trip(tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(minutes=20)),
                      month="2024-01")
    r = run_months(spark, rows, tmp_out, [("yellow", "2024-01")], write_reports=False)
    m = r.months.collect()[0]
    assert m.feature_rows == 2 and m.n_partitions == 2                # H13


def test_empty_month(spark, make_trips, tmp_out):
    empty = make_trips(trip(), month="2024-01").limit(0)
    r = run_months(spark, empty, tmp_out, [("yellow", "2024-01")], write_reports=False)
    assert r.months.collect() == []      # only months with rows are accounted for


def test_flat_monthly_files(spark, make_trips, tmp_out):
    landing = f"{tmp_out}/landing"
    make_trips(trip(), trip(VendorID=99)).drop("taxi_type", "file_month") \
        .write.parquet(f"{landing}/yellow_tripdata_2024-01.parquet")
    make_trips(trip()).drop("taxi_type", "file_month") \
        .write.parquet(f"{landing}/green_tripdata_2024-02.parquet")
    raw = read_trips(spark, [f"{landing}/yellow_tripdata_2024-01.parquet",
                             f"{landing}/green_tripdata_2024-02.parquet"])
    got = {(r.taxi_type, r.file_month): r["count"] for r in raw.groupBy("taxi_type", "file_month").count().collect()}
    assert got == {("yellow", "2024-01"): 2, ("green", "2024-02"): 1}
    r = run_files(spark, [f"{landing}/yellow_tripdata_2024-01.parquet"], f"{tmp_out}/out")
    m = r.months.collect()[0]
    assert (m.raw_rows, m.valid_rows, m.feature_rows) == (2, 1, 1)


def test_bad_file_name_rejected(spark):
    with pytest.raises(ValueError):
        read_trips(spark, ["/nowhere/trips.parquet"])


def test_missing_input_raises(spark):
    with pytest.raises(Exception):
        read_trips(spark, ["/nowhere/yellow_tripdata_2024-01.parquet"]).count()


def test_run_range_skips_missing_months(spark, make_trips, tmp_out):
    from tripforge.plans.pipeline import run_range
    from tripforge.sources.trips import land
    landing = f"{tmp_out}/landing"
    land(make_trips(trip(), trip(VendorID=99), month="2024-01")
         .unionByName(make_trips(trip(), month="2024-03")), landing)
    r = run_range(spark, landing, f"{tmp_out}/out", "2023-12", "2024-03")
    got = {m.file_month: (m.raw_rows, m.valid_rows) for m in r.months.collect()}
    assert got == {"2024-01": (2, 1), "2024-03": (1, 1)}
    with pytest.raises(FileNotFoundError):
        run_range(spark, landing, f"{tmp_out}/out2", "2023-12", "2024-03", fail_fast=True)


def test_report_paths(spark, fixture_run):
    v = fixture_run.validation.orderBy("file_month").collect()[0]
    assert v.valid_path.endswith("_dq_status=valid/taxi_type=yellow/file_month=2024-01")
    assert v.quarantine_path.endswith("quarantine/taxi_type=yellow/file_month=2024-01")
    t = fixture_run.transform.orderBy("file_month").collect()[0]
    assert t.output_path.endswith("features/taxi_type=yellow/file_month=2024-01")
    assert dict(t.dropped_by_reason)["duration_too_short"] > 0


def test_cli_run(spark, tmp_out):
    from tripforge.__main__ import main
    from tripforge.sources.trips import land
    land(trips(spark, "/root/testdata/sf0.001"), f"{tmp_out}/landing")
    assert main(["run", "--landing", f"{tmp_out}/landing", "--out", f"{tmp_out}/out",
                 "--start", "2023-12", "--end", "2024-01"]) == 0
    assert S.read_valid(spark, f"{tmp_out}/out/validated").count() == 314


def test_hot_day_is_split_across_files(spark, make_trips, tmp_out):
    """A day holding most rows is written by several tasks (AQE splits the
    skewed rebalance partition), not funnelled through one task."""
    from tripforge.operators import transform as X
    hot = [trip() for _ in range(4000)]                                  # all on 2024-01-15
    cold = [trip(tpep_pickup_datetime=dt.datetime(2024, 1, d, 8, 0),
                 tpep_dropoff_datetime=dt.datetime(2024, 1, d, 8, 20)) for d in (2, 3, 4)]
    df = make_trips(*(hot + cold)).repartition(8)                        # several map tasks
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        S.write_features(X.build_features(df), tmp_out)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    day = os.path.join(local_path(tmp_out), "taxi_type=yellow", "file_month=2024-01",
                       "pickup_date=2024-01-15")
    files = [f for f in os.listdir(day) if f.endswith(".parquet")]
    assert len(files) > 1
    assert S.read_features(spark, tmp_out).count() == 4003


def test_shuffle_partitions_follow_input_size(spark, make_trips, tmp_out):
    floor = max(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    local = make_trips(*[trip() for _ in range(50)]).repartition(4)
    assert S.shuffle_partitions_for(local) == floor               # no statistics -> default
    local.write.parquet(f"{tmp_out}/t")
    files = spark.read.parquet(f"{tmp_out}/t")
    est = S.plan_bytes(files)
    assert 0 < est < 10 ** 9                                        # file-size based estimate
    assert S.shuffle_partitions_for(files) == floor
    assert S.shuffle_partitions_for(files, target_bytes=max(1, est // 100)) >= 100


def test_rerun_removes_days_that_lost_all_rows(spark, make_trips, tmp_out):
    d15 = dict(tpep_pickup_datetime=dt.datetime(2024, 1, 15, 8, 0), tpep_dropoff_datetime=dt.datetime(2024, 1, 15, 8, 20))
    d16 = dict(tpep_pickup_datetime=dt.datetime(2024, 1, 16, 8, 0), tpep_dropoff_datetime=dt.datetime(2024, 1, 16, 8, 20))
    run_months(spark, make_trips(trip(**d15), trip(**d16)), tmp_out, [("yellow", "2024-01")], write_reports=False)
    month_dir = os.path.join(local_path(tmp_out), "features", "taxi_type=yellow", "file_month=2024-01")
    assert sorted(os.listdir(month_dir)) == ["pickup_date=2024-01-15", "pickup_date=2024-01-16"]
    run_months(spark, make_trips(trip(**d15), trip(**d15)), tmp_out, [("yellow", "2024-01")], write_reports=False)
    assert sorted(d for d in os.listdir(month_dir) if d.startswith("pickup_date")) == ["pickup_date=2024-01-15"]
    assert S.read_features(spark, f"{tmp_out}/features").count() == 2


def test_all_quarantined_month_clears_valid(spark, make_trips, tmp_out):
    run_months(spark, make_trips(trip(), trip()), tmp_out, [("yellow", "2024-01")], write_reports=False)
    r = run_months(spark, make_trips(trip(VendorID=99)), tmp_out, [("yellow", "2024-01")], write_reports=False)
    v_schema = S.validated_schema(make_trips(trip()).schema)
    assert S.read_valid(spark, f"{tmp_out}/validated", v_schema).count() == 0
    assert S.read_quarantine_table(spark, f"{tmp_out}/quarantine").count() == 1
    m = r.months.collect()[0]
    assert (m.raw_rows, m.valid_rows, m.feature_rows) == (1, 0, 0)


def test_cli_thresholds(spark, make_trips, tmp_out):
    from tripforge.__main__ import main
    from tripforge.sources.trips import land
    land(make_trips(trip(), trip(fare_amount=50.0)), f"{tmp_out}/landing")
    assert main(["run", "--landing", f"{tmp_out}/landing", "--out", f"{tmp_out}/out",
                 "--month", "2024-01", "--min-fare-amount", "20"]) == 0
    assert S.read_features(spark, f"{tmp_out}/out/features").count() == 1    # 14.5 < 20 dropped


def test_months_with_different_schemas(spark, make_trips, tmp_out):
    """An absent column, a wider type and another spelling in one run; an
    unreadable month is left out and named, or raises with fail_fast."""
    from pyspark.sql import functions as F
    from tripforge.plans.pipeline import run_range
    from tripforge.session import local_path
    from tripforge.sources import landing as L
    root = f"{tmp_out}/landing"

    def month(m):
        return f"{root}/yellow_tripdata_{m}.parquet"
    rows = make_trips(trip(Airport_fee=1.75), trip(VendorID=77), trip(extra=None)).drop("taxi_type", "file_month")
    rows.write.parquet(month("2024-01"))
    rows.drop("Airport_fee", "extra").withColumn("VendorID", F.col("VendorID").cast("long")).write.parquet(month("2023-01"))
    rows.withColumnRenamed("Airport_fee", "airport_fee").withColumn("note", F.lit("x")).write.parquet(month("2023-02"))
    os.makedirs(local_path(month("2023-03")))
    with open(f"{local_path(month('2023-03'))}/part-0.parquet", "wb") as f:
        f.write(b"no parquet at all")
    r = run_range(spark, root, f"{tmp_out}/out", "2023-01", "2024-01")
    got = {m.file_month: (m.raw_rows, m.valid_rows) for m in r.months.collect()}
    # a column that a month does not have fails none of its rows
    assert got == {"2024-01": (3, 1), "2023-01": (3, 2), "2023-02": (3, 1)}
    assert [s[:2] for s in r.skipped] == [("yellow", "2023-03")]
    feats = S.read_features(spark, r.features_root)
    assert "_absent_columns" not in feats.columns
    airport = {(f.file_month, f.is_airport_trip) for f in feats.collect()}
    assert airport == {("2024-01", True), ("2023-01", False), ("2023-02", True)}
    failed = {(f.file_month, f.rule): f.n for f in r.failures.collect()}
    assert failed[("2023-01", "VendorID:isin")] == 1 and ("2023-01", "extra:not_nullable") not in failed
    with pytest.raises(Exception):
        run_range(spark, root, f"{tmp_out}/out2", "2023-01", "2023-03", fail_fast=True)
    drift = {(d.month, d.column_name, d.issue) for d in
             L.file_schema_drift(spark, root, RAW_TRIP_SCHEMA).collect() if d.column_name != "trip_id"}
    assert drift == {("2023-01", "Airport_fee", "missing"), ("2023-01", "extra", "missing"), ("2023-01", "VendorID", "wrong_type"),
                     ("2023-02", "Airport_fee", "missing"), ("2023-02", "airport_fee", "extra"), ("2023-02", "note", "extra"),
                     ("2023-03", None, "unreadable")}


def test_raw_rows_are_read_once(spark, make_trips, tmp_out):
    """Validation, features, quarantine and every count come from one pass over raw rows."""
    seen = spark.sparkContext.accumulator(0)
    raw = make_trips(*[trip() for _ in range(40)], *[trip(VendorID=99) for _ in range(5)],
                     *[trip(trip_distance=0.0) for _ in range(3)]).repartition(3)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    r = run_months(spark, raw.mapInArrow(counted, raw.schema), tmp_out, [("yellow", "2024-01")])
    m = r.months.collect()[0]
    assert (m.raw_rows, m.valid_rows, m.feature_rows, m.quarantined_rows) == (48, 43, 40, 5)
    assert seen.value == 48
    assert {d.reason: d.n for d in r.drops.collect() if d.n} == {"zero_distance": 3}
    assert len(r.drops.collect()) == 6                                # reasons without a hit stay
    assert S.read_valid(spark, r.validated_root).count() == 43
    assert S.read_features(spark, r.features_root).count() == 40


def test_rerun_removes_outlier_partitions(spark, make_trips, tmp_out):
    run_months(spark, make_trips(trip(), trip(trip_distance=0.0)), tmp_out, [("yellow", "2024-01")], write_reports=False)
    r = run_months(spark, make_trips(trip()), tmp_out, [("yellow", "2024-01")], write_reports=False)
    assert S.read_valid(spark, r.validated_root).count() == 1
    assert {d.n for d in r.drops.collect()} == {0}
    r = run_months(spark, make_trips(trip(trip_distance=0.0)), tmp_out, [("yellow", "2024-01")], write_reports=False)
    m = r.months.collect()[0]
    assert (m.valid_rows, m.feature_rows, m.n_partitions) == (1, 0, 0)
    assert S.read_valid(spark, r.validated_root).count() == 1


def test_outliers_of_raw_rows_are_those_of_featured_rows(spark):
    from tripforge.functions.outliers import any_outlier_sql
    from tripforge.operators import transform as X
    raw = trips(spark, SF01)
    told = raw.selectExpr("trip_id", f"{X.outlier_of_raw_sql(raw)} AS o")
    want = X.featured(raw).selectExpr("trip_id", f"{any_outlier_sql()} AS o")
    assert told.exceptAll(want).count() == 0 and told.filter("o").count() > 1000
    text = raw.withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("string"))
    told = text.selectExpr("trip_id", f"{X.outlier_of_raw_sql(text)} AS o")
    assert told.exceptAll(want).count() == 0                          # coerced first, as the features are


@pytest.mark.parametrize("layout", ["flat", "hive"])
def test_month_that_breaks_while_it_is_read(spark, make_trips, tmp_out, layout):
    """Sound footers, but a damaged row group in one of three months: the two
    others land, the third is named; with fail_fast the run raises."""
    import glob
    from tripforge.plans.pipeline import run_range
    from tripforge.sources.trips import land
    root = f"{tmp_out}/landing one"
    for i, m in enumerate(("2024-01", "2024-02", "2024-03")):
        rows = make_trips(*[trip(trip_distance=1.0 + k / 7, VendorID=99 if k == 0 else 1) for k in range(200)], month=m).coalesce(1)
        if layout == "flat":
            rows.drop("taxi_type", "file_month").write.parquet(f"{root}/yellow_tripdata_{m}.parquet")
        else:
            land(rows, root)
    part = glob.glob(local_path(root) + "/*2024-02*/*.parquet") + glob.glob(local_path(root) + "/*/*2024-02*/*.parquet")
    for p in part:
        data = bytearray(open(p, "rb").read())
        for i in range(4, len(data) // 2):                 # pages, not the footer
            data[i] ^= 0x5A
        with open(p, "wb") as f:
            f.write(data)
        crc = os.path.join(os.path.dirname(p), f".{os.path.basename(p)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    r = run_range(spark, root, f"{tmp_out}/out", "2024-01", "2024-03")
    assert {m.file_month: (m.raw_rows, m.valid_rows) for m in r.months.collect()} == {"2024-01": (200, 199), "2024-03": (200, 199)}
    assert [s[:2] for s in r.skipped] == [("yellow", "2024-02")]
    assert S.read_features(spark, r.features_root).count() == 398
    assert {x.file_month for x in S.read_valid(spark, r.validated_root).select("file_month").distinct().collect()} == {"2024-01", "2024-03"}
    with pytest.raises(Exception):
        run_range(spark, root, f"{tmp_out}/out2", "2024-01", "2024-03", fail_fast=True)
