"""T1-T4, F1-F13, O1-O8."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import trip
from tripforge.config import OUTLIER_REASONS, Thresholds
from tripforge.functions.coerce import parse_datetime
from tripforge.operators import transform as X


def feat(make_trips, **kw):
    return X.featured(make_trips(trip(**kw))).collect()[0]


def test_coercion_types(make_trips):
    df = X.coerce_types(make_trips(trip()))
    types = dict(df.dtypes)
    assert types["VendorID"] == "tinyint" and types["payment_type"] == "tinyint"
    assert types["PULocationID"] == "smallint" and types["RatecodeID"] == "smallint"
    assert types["passenger_count"] == "tinyint"


@pytest.mark.parametrize("value,expected", [(0.5, 0), (1.5, 2), (2.5, 2), (3.0, 3), (None, None)])
def test_passenger_rounding_half_even(make_trips, value, expected):
    r = X.coerce_types(make_trips(trip(passenger_count=value))).collect()[0]
    assert r.passenger_count == expected


def test_rate_code_99_kept(make_trips):
    assert X.coerce_types(make_trips(trip(RatecodeID=99.0))).collect()[0].RatecodeID == 99


def test_text_dates_parsed_and_garbage_null(spark):
    df = spark.createDataFrame([("2024-01-15 08:30:00",), ("not a date",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_datetime(F.col("s"), T.StringType())).collect()]
    assert got == [dt.datetime(2024, 1, 15, 8, 30), None, None]


def test_base_features(make_trips):
    r = feat(make_trips)
    assert r.trip_duration_min == 25.0
    assert r.trip_speed_mph == 4.5 / (25.0 / 60.0)
    assert r.tip_pct == 100.0 * 2.2 / 11.0
    assert r.is_rush_hour is True and r.is_weekend is False
    assert r.pickup_date == "2024-01-15" and r.pickup_day_name == "Monday"
    assert r.pickup_dayofweek == 0 and r.pickup_hour == 8
    assert r.time_of_day == "morning"


def test_sub_second_duration(make_trips):
    r = feat(make_trips, tpep_dropoff_datetime=dt.datetime(2024, 1, 15, 8, 30, 0, 500000))
    assert r.trip_duration_min == 0.5 / 60.0


def test_equal_times_speed_null(make_trips):
    ts = dt.datetime(2024, 1, 15, 8, 30)
    r = feat(make_trips, tpep_pickup_datetime=ts, tpep_dropoff_datetime=ts)
    assert r.trip_speed_mph is None and r.cost_per_min is None


@pytest.mark.parametrize("hour,label", [(3, "night"), (5, "night"), (6, "morning"), (11, "morning"),
                                        (12, "afternoon"), (14, "afternoon"), (16, "afternoon"),
                                        (17, "evening"), (20, "evening"), (21, "night"), (23, "night")])
def test_time_of_day_buckets(make_trips, hour, label):
    p = dt.datetime(2024, 1, 15, hour, 0)
    r = feat(make_trips, tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(minutes=10))
    assert r.time_of_day == label


@pytest.mark.parametrize("hour,rush", [(6, False), (7, True), (9, True), (10, False), (15, False),
                                       (16, True), (18, True), (19, False)])
def test_rush_hour_edges(make_trips, hour, rush):
    p = dt.datetime(2024, 1, 15, hour, 0)
    r = feat(make_trips, tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(minutes=10))
    assert r.is_rush_hour is rush


def test_weekend_never_rush(make_trips):
    p = dt.datetime(2024, 1, 13, 8, 30)  # Saturday
    r = feat(make_trips, tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(minutes=25))
    assert r.is_weekend is True and r.is_rush_hour is False and r.pickup_dayofweek == 5


def test_zero_distance_ratio_null(make_trips):
    assert feat(make_trips, trip_distance=0.0).fare_per_mile is None


@pytest.mark.parametrize("fee,airport", [(1.75, True), (0.0, False), (None, False)])
def test_airport_flag(make_trips, fee, airport):
    assert feat(make_trips, Airport_fee=fee).is_airport_trip is airport


def test_airport_flag_absent_column(make_trips):
    df = X.featured(make_trips(trip()).drop("Airport_fee"))
    assert df.collect()[0].is_airport_trip is False


def flags(make_trips, **kw):
    r = X.outlier_flags(X.featured(make_trips(trip(**kw)))).collect()[0]
    return {k for k in OUTLIER_REASONS if r[k]}


@pytest.mark.parametrize("override,reasons", [
    ({"tpep_dropoff_datetime": dt.datetime(2024, 1, 15, 8, 30, 5)},
     {"duration_too_short", "speed_implausible"}),                 # 4.5 mi in 5 s
    ({"tpep_dropoff_datetime": dt.datetime(2024, 1, 15, 8, 30, 5), "trip_distance": 0.001},
     {"duration_too_short"}),
    ({"tpep_dropoff_datetime": dt.datetime(2024, 1, 15, 12, 30)}, {"duration_too_long"}),
    ({"fare_amount": 0.0}, {"non_positive_fare"}),
    ({"fare_amount": 0.005}, {"non_positive_fare"}),
    ({"passenger_count": 0.0}, {"too_few_passengers"}),
    ({"passenger_count": 0.5}, {"too_few_passengers"}),
    ({"passenger_count": None}, set()),
    ({"trip_distance": 0.0, "tpep_dropoff_datetime": dt.datetime(2024, 1, 15, 8, 30, 5)},
     {"zero_distance", "duration_too_short"}),
    ({"trip_distance": 100.0}, {"speed_implausible"}),
])
def test_outlier_rules(make_trips, override, reasons):
    assert flags(make_trips, **override) == reasons


@pytest.mark.parametrize("override", [
    {"tpep_dropoff_datetime": dt.datetime(2024, 1, 15, 8, 30, 30),    # exactly 0.5 min
     "trip_distance": 0.5},
    {"tpep_dropoff_datetime": dt.datetime(2024, 1, 15, 11, 30)},      # exactly 180 min
    {"fare_amount": 0.01},
    {"trip_distance": 100.0 * 25.0 / 60.0},                           # exactly 100 mph
])
def test_outlier_bounds_keep(make_trips, override):
    assert flags(make_trips, **override) == set()


def test_drop_once_and_counts_each_reason(make_trips):
    df = X.featured(make_trips(
        trip(trip_distance=0.0, tpep_dropoff_datetime=dt.datetime(2024, 1, 15, 8, 30, 5)),
        trip(), trip(passenger_count=None)))
    assert X.filter_outliers(df).count() == 2
    counts = {r.reason: r.n for r in X.dropped_by_reason(df).collect()}
    assert set(counts) == set(OUTLIER_REASONS)           # all keys, zeros too
    assert counts["zero_distance"] == 1 and counts["duration_too_short"] == 1
    assert sum(counts.values()) >= 1


def test_thresholds_are_parameters(make_trips):
    df = X.featured(make_trips(trip(fare_amount=5.0)))
    assert X.filter_outliers(df, Thresholds(min_fare_amount=10.0)).count() == 0


def test_thresholds_validated():
    with pytest.raises(ValueError):
        Thresholds(max_trip_speed_mph=0)


def test_feature_table_known_answer(spark):
    from tripforge.operators import quarantine as Q
    from tripforge.sources.fixtures import trips
    t = trips(spark, "/root/testdata/sf0.01")
    feats = X.build_features(Q.valid_rows(t))
    assert feats.count() == 7513
    counts = {r.reason: r.n for r in X.dropped_by_reason(X.featured(Q.valid_rows(t)), []).collect()}
    assert counts == {"duration_too_short": 343, "duration_too_long": 103, "speed_implausible": 368,
                      "non_positive_fare": 179, "zero_distance": 143, "too_few_passengers": 944}


def test_coerce_types_parses_text_timestamps(spark):
    df = spark.createDataFrame([("2024-01-15 08:30:00", "2024-01-15 08:55:00", 2.5, 99.0),
                                ("garbage", "2024-01-15 08:55:00", None, None)],
                               "tpep_pickup_datetime string, tpep_dropoff_datetime string, "
                               "passenger_count double, RatecodeID double")
    out = X.coerce_types(df)
    types = dict(out.dtypes)
    assert types["tpep_pickup_datetime"] == "timestamp_ntz"
    rows = out.collect()
    assert rows[0].tpep_pickup_datetime == dt.datetime(2024, 1, 15, 8, 30)
    assert rows[1].tpep_pickup_datetime is None
    assert (rows[0].passenger_count, rows[0].RatecodeID) == (2, 99)


def test_feature_table_columns_and_types(make_trips):
    df = X.build_features(make_trips(trip()))
    assert df.columns[-13:] == list(__import__("tripforge.functions.features", fromlist=["x"]).FEATURE_COLUMNS)
    types = dict(df.dtypes)
    assert types["pickup_hour"] == "tinyint" and types["is_weekend"] == "boolean"
    assert types["pickup_date"] == "string" and types["trip_speed_mph"] == "double"
