"""Contract rules, reasons, split, counts, schema drift."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import trip
from tripforge.functions.contract import TRIP_CONTRACT
from tripforge.operators import quarantine as Q
from tripforge.sources.trips import normalise_nan


def reasons_of(df):
    return [r[0] for r in Q.quarantine_rows(df).orderBy("trip_id").select(Q.REASONS_COL).collect()]


def violated(df):
    return [(r.column_name, r.check_name) for r in Q.violations(df, ["trip_id"]).orderBy("rule_no").collect()]


def test_clean_row_has_no_violations(make_trips):
    df = make_trips(trip())
    assert violated(df) == []
    assert Q.valid_rows(df).count() == 1


@pytest.mark.parametrize("override,column", [
    ({"VendorID": 99}, "VendorID"),
    ({"trip_distance": -1.0}, "trip_distance"),
    ({"trip_distance": 312722.0}, "trip_distance"),
    ({"PULocationID": 300}, "PULocationID"),
    ({"fare_amount": -999999.0}, "fare_amount"),
    ({"payment_type": 99}, "payment_type"),
    ({"passenger_count": 12.0}, "passenger_count"),
    ({"RatecodeID": 8.0}, "RatecodeID"),
    ({"store_and_fwd_flag": "X"}, "store_and_fwd_flag"),
    ({"total_amount": 20000.0}, "total_amount"),
])
def test_value_violations(make_trips, override, column):
    assert column in [c for c, _ in violated(make_trips(trip(**override)))]


def test_nullable_column_allows_null(make_trips):
    assert violated(make_trips(trip(passenger_count=None, RatecodeID=None,
                                    store_and_fwd_flag=None, congestion_surcharge=None,
                                    Airport_fee=None))) == []


def test_rate_code_99_allowed(make_trips):
    assert violated(make_trips(trip(RatecodeID=99.0))) == []


def test_multiple_bad_columns_one_row(make_trips):
    df = make_trips(trip(VendorID=99, trip_distance=-5.0))
    assert violated(df) == [("VendorID", "isin"), ("trip_distance", "ge")]
    assert reasons_of(df) == ["VendorID:isin=99; trip_distance:ge=-5.0"]


@pytest.mark.parametrize("column", [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance",
    "PULocationID", "DOLocationID", "payment_type", "fare_amount", "extra", "mta_tax",
    "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount"])
def test_required_column_null_is_one_not_nullable_failure(make_trips, column):
    got = violated(make_trips(trip(**{column: None})))
    assert got == [(column, "not_nullable")]


def test_dropoff_before_pickup(make_trips):
    df = make_trips(trip(tpep_pickup_datetime=dt.datetime(2024, 1, 15, 9),
                         tpep_dropoff_datetime=dt.datetime(2024, 1, 15, 8)))
    assert reasons_of(df) == ["tpep_dropoff_datetime:lt_pickup"]


def test_equal_timestamps_pass(make_trips):
    ts = dt.datetime(2024, 1, 15, 8, 30)
    assert violated(make_trips(trip(tpep_pickup_datetime=ts, tpep_dropoff_datetime=ts))) == []


@pytest.mark.parametrize("override", [
    {"trip_distance": 500.0}, {"trip_distance": 0.0}, {"passenger_count": 9.0},
    {"passenger_count": 0.0}, {"PULocationID": 1}, {"PULocationID": 265},
    {"DOLocationID": 1}, {"DOLocationID": 265}, {"fare_amount": -1000.0},
    {"fare_amount": 10000.0}, {"total_amount": -1000.0}, {"total_amount": 10000.0},
    {"payment_type": 0}, {"payment_type": 6}, {"VendorID": 7}])
def test_bounds_are_inclusive(make_trips, override):
    assert violated(make_trips(trip(**override))) == []


def test_reason_text_quotes_strings_and_marks_null(make_trips):
    df = make_trips(trip(store_and_fwd_flag="X", extra=None))
    assert reasons_of(df) == ["store_and_fwd_flag:isin='X'; extra:not_nullable=None"]


def test_split_three_rows(make_trips):
    df = make_trips(trip(), trip(VendorID=99), trip(trip_distance=-5.0))
    valid, quarantined = Q.split(df)
    assert valid.count() == 1
    assert Q.REASONS_COL not in valid.columns          # C37
    q = quarantined.orderBy("trip_id").collect()
    assert [r.trip_id for r in q] == [1, 2]
    assert all(r[Q.REASONS_COL] for r in q)


def test_nan_is_missing_after_normalise(make_trips):
    df = normalise_nan(make_trips(trip(trip_distance=float("nan"), passenger_count=float("nan"))))
    assert violated(df) == [("trip_distance", "not_nullable")]


def test_nan_without_normalise_would_misfire(make_trips):
    # documents H1: Spark orders NaN above every number
    df = make_trips(trip(passenger_count=float("nan")))
    assert ("passenger_count", "le") in violated(df)


def test_rule_hits_keep_zero_rules(make_trips):
    df = make_trips(trip(), trip(VendorID=99))
    hits = {r.rule: r.n for r in Q.rule_hits(df).collect()}
    assert len(hits) == len(TRIP_CONTRACT.rules) == 31
    assert hits["VendorID:isin"] == 1 and hits["fare_amount:le"] == 0


def test_failure_counts_positive_only(make_trips):
    df = make_trips(trip(VendorID=99), trip(VendorID=99, trip_distance=-1.0), trip())
    got = {(r.rule, r.n) for r in Q.failure_counts(df, ["file_month"]).collect()}
    assert got == {("VendorID:isin", 2), ("trip_distance:ge", 1)}


def test_schema_drift_reports_extra_missing_wrong(make_trips):
    df = make_trips(trip()).drop("Airport_fee").withColumn("VendorID", F.col("VendorID").cast("long"))
    drift = {(r.column_name, r.issue) for r in Q.schema_drift(df).collect()}
    assert ("Airport_fee", "missing") in drift
    assert ("VendorID", "wrong_type") in drift
    assert ("trip_id", "extra") in drift


def test_missing_value_column_is_skipped_not_failed(make_trips):
    df = make_trips(trip(VendorID=99)).drop("VendorID")
    assert violated(df) == []


def test_missing_datetime_column_raises(make_trips):
    df = make_trips(trip()).drop("tpep_pickup_datetime")
    with pytest.raises(ValueError):
        Q.valid_rows(df)


def test_valid_plus_quarantined_equals_total(spark):
    from tripforge.sources.fixtures import trips
    t = trips(spark, "/root/testdata/sf0.01")
    total = t.count()
    v, q = Q.split(t)
    assert total == 10000
    assert v.count() + q.count() == total
    assert q.count() == 738                       # known answer (SURVEY §5)
    assert not math.isnan(float(total))


def test_sql_literals_and_identifiers():
    from tripforge.functions.rules import ident, sql_literal
    assert sql_literal(0.05) == "CAST('0.05' AS DOUBLE)"
    assert sql_literal(7) == "7" and sql_literal(True) == "TRUE" and sql_literal(None) == "NULL"
    assert sql_literal("it's") == "'it\\'s'"
    assert ident("a`b") == "`a``b`"


def test_custom_rules_sql_and_column(spark):
    from pyspark.sql import functions as F
    from tripforge.functions import rules as R
    from tripforge.functions.contract import Contract
    df = spark.createDataFrame([(1, "x y", 5.0), (2, "ok", -1.0), (3, None, 2.0)], "id int, `odd name` string, v double")
    c = Contract(rules=(R.custom("v", "positive", "v <= 0"),
                        R.custom("odd name", "no_space", lambda: F.col("`odd name`").contains(" ")),
                        R.isin("odd name", ["x y", "it's"])))
    got = {r.id: r[Q.REASONS_COL] for r in Q.quarantine_rows(df, c).collect()}
    assert got == {1: "odd name:no_space='x y'", 2: "v:positive=-1.0; odd name:isin='ok'"}
    hits = {r.rule: r.n for r in Q.rule_hits(df, contract=c).collect()}
    assert hits == {"v:positive": 1, "odd name:no_space": 1, "odd name:isin": 1}
    v = {(r.id, r.column_name, r.check_name) for r in Q.violations(df, ["id"], c).collect()}
    assert v == {(1, "odd name", "no_space"), (2, "v", "positive"), (2, "odd name", "isin")}


def test_reason_without_value_and_rule_order(spark):
    from tripforge.functions import rules as R
    from tripforge.functions.contract import Contract
    df = spark.createDataFrame([(1, 5, 3), (2, 1, 9)], "id int, a int, b int")
    c = Contract(rules=(R.before("a", "b", "lt_b"), R.custom("b", "small", "b > 4", show_value=False),
                        R.le("a", 4)))
    got = {r.id: r[Q.REASONS_COL] for r in Q.quarantine_rows(df, c).collect()}
    assert got == {2: "a:lt_b; b:small", 1: "a:le=5"}


def test_contract_on_other_table_counts(spark):
    """The same operators on a non-trip table (customer at sf0.01)."""
    from tripforge.functions import rules as R
    from tripforge.functions.contract import Contract
    cust = spark.read.parquet("/root/testdata/sf0.01/customer.parquet")
    c = Contract(rules=(R.ge("c_acctbal", 0), R.not_nullable("c_mktsegment")))
    assert Q.quarantine_rows(cust, c).count() == 122          # counted independently in DuckDB
    v, q = Q.split(cust, c)
    assert v.count() + q.count() == cust.count()
