"""The raw trip contract (C1-C31) and its expected schema (for C32).

A contract is an ordered list of rules plus the expected column types.  Rule
order is the order reasons appear in ``_quarantine_reasons``: column rules in
column order, the cross-column temporal rule last.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from tripforge import config as C
from tripforge.functions.rules import Rule, before, ge, isin, le, not_nullable


@dataclass(frozen=True)
class Contract:
    rules: tuple[Rule, ...]
    expected: T.StructType = field(default_factory=T.StructType)
    strict: bool = False  # strict=True would also flag extra columns as errors

    @property
    def keys(self) -> list[str]:
        return [r.key for r in self.rules]


PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

RAW_TRIP_SCHEMA = T.StructType([
    T.StructField("VendorID", T.IntegerType(), False),
    T.StructField(PICKUP, T.TimestampNTZType(), False),
    T.StructField(DROPOFF, T.TimestampNTZType(), False),
    T.StructField("passenger_count", T.DoubleType(), True),
    T.StructField("trip_distance", T.DoubleType(), False),
    T.StructField("RatecodeID", T.DoubleType(), True),
    T.StructField("store_and_fwd_flag", T.StringType(), True),
    T.StructField("PULocationID", T.IntegerType(), False),
    T.StructField("DOLocationID", T.IntegerType(), False),
    T.StructField("payment_type", T.LongType(), False),
    T.StructField("fare_amount", T.DoubleType(), False),
    T.StructField("extra", T.DoubleType(), False),
    T.StructField("mta_tax", T.DoubleType(), False),
    T.StructField("tip_amount", T.DoubleType(), False),
    T.StructField("tolls_amount", T.DoubleType(), False),
    T.StructField("improvement_surcharge", T.DoubleType(), False),
    T.StructField("total_amount", T.DoubleType(), False),
    T.StructField("congestion_surcharge", T.DoubleType(), True),
    T.StructField("Airport_fee", T.DoubleType(), True),
])
RAW_TRIP_COLUMNS = [f.name for f in RAW_TRIP_SCHEMA.fields]

TRIP_RULES: tuple[Rule, ...] = (
    not_nullable("VendorID"),                                   # C1
    isin("VendorID", C.VALID_VENDOR_IDS),                       # C2
    not_nullable(PICKUP),                                       # C3
    not_nullable(DROPOFF),                                      # C4
    ge("passenger_count", C.PASSENGER_MIN),                     # C5
    le("passenger_count", C.PASSENGER_MAX),                     # C6
    not_nullable("trip_distance"),                              # C7
    ge("trip_distance", 0),                                     # C8
    le("trip_distance", C.DISTANCE_MAX),                        # C9
    isin("RatecodeID", C.VALID_RATE_CODES),                     # C10
    isin("store_and_fwd_flag", C.VALID_STORE_AND_FWD_FLAGS),    # C11
    not_nullable("PULocationID"),                               # C12
    ge("PULocationID", C.LOCATION_ID_MIN),                      # C13
    le("PULocationID", C.LOCATION_ID_MAX),                      # C14
    not_nullable("DOLocationID"),                               # C15
    ge("DOLocationID", C.LOCATION_ID_MIN),                      # C16
    le("DOLocationID", C.LOCATION_ID_MAX),                      # C17
    not_nullable("payment_type"),                               # C18
    isin("payment_type", C.VALID_PAYMENT_TYPES),                # C19
    not_nullable("fare_amount"),                                # C20
    ge("fare_amount", C.MONEY_MIN),                             # C21
    le("fare_amount", C.MONEY_MAX),                             # C22
    not_nullable("extra"),                                      # C23
    not_nullable("mta_tax"),                                    # C24
    not_nullable("tip_amount"),                                 # C25
    not_nullable("tolls_amount"),                               # C26
    not_nullable("improvement_surcharge"),                      # C27
    not_nullable("total_amount"),                               # C28
    ge("total_amount", C.MONEY_MIN),                            # C29
    le("total_amount", C.MONEY_MAX),                            # C30
    before(DROPOFF, PICKUP, "lt_pickup"),                       # C31
)

TRIP_CONTRACT = Contract(rules=TRIP_RULES, expected=RAW_TRIP_SCHEMA, strict=False)
