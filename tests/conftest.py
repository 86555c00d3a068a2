import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tripforge.functions.contract import RAW_TRIP_SCHEMA  # noqa: E402
from tripforge.session import apply_engine_conf, scratch_path, shared_root  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_engine_conf(s)
    shared_root(s)
    yield s


@pytest.fixture
def tmp_out(spark):
    return scratch_path(spark, "test")


BASE = {
    "VendorID": 1,
    "tpep_pickup_datetime": dt.datetime(2024, 1, 15, 8, 30, 0),   # a Monday
    "tpep_dropoff_datetime": dt.datetime(2024, 1, 15, 8, 55, 0),
    "passenger_count": 3.0,
    "trip_distance": 4.5,
    "RatecodeID": 5.0,
    "store_and_fwd_flag": "Y",
    "PULocationID": 48,
    "DOLocationID": 79,
    "payment_type": 2,
    "fare_amount": 11.0,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 2.2,
    "tolls_amount": 6.94,
    "improvement_surcharge": 1.0,
    "total_amount": 22.64,
    "congestion_surcharge": 0.75,
    "Airport_fee": 0.0,
}


def trip(**overrides):
    return BASE | overrides


@pytest.fixture
def make_trips(spark):
    """DataFrame with the raw contract schema (+ trip_id, taxi_type, file_month)."""
    from pyspark.sql import types as T

    def _make(*rows, month="2024-01"):
        schema = T.StructType([T.StructField("trip_id", T.LongType())]
                              + [T.StructField(f.name, f.dataType, True) for f in RAW_TRIP_SCHEMA.fields]
                              + [T.StructField("taxi_type", T.StringType()),
                                 T.StructField("file_month", T.StringType())])
        data = []
        for i, r in enumerate(rows):
            data.append(tuple([i] + [r.get(f.name) for f in RAW_TRIP_SCHEMA.fields]
                              + [r.get("taxi_type", "yellow"), r.get("file_month", month)]))
        return spark.createDataFrame(data, schema)
    return _make
