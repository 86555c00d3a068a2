"""A2-A7, R1-R4 on report relations ."""

import json

from pyspark.sql import functions as F

from tripforge.operators import reports as RP
from tripforge.plans.accounting import accounting_rows


def months(spark, rows):
    df = spark.createDataFrame(rows, "taxi_type string, file_month string, raw_rows bigint, "
                                     "valid_rows bigint, feature_rows bigint, n_partitions bigint")
    return accounting_rows(df)


def test_top_reasons_order_ties_zeros_limit(spark):
    counts = spark.createDataFrame([("m", "a", 1), ("m", "b", 5), ("m", "c", 3), ("m", "z", 2),
                                    ("m", "y", 2), ("m", "zero", 0)], "g string, reason string, n bigint")
    got = [(r.reason, r.n) for r in RP.top_reasons(counts, ["g"], "reason", k=10).orderBy("rank").collect()]
    assert got == [("b", 5), ("c", 3), ("y", 2), ("z", 2), ("a", 1)]
    assert RP.top_reasons(counts, ["g"], "reason", k=3).count() == 3


def test_run_totals_and_retention(spark):
    m = months(spark, [("yellow", "2023-07", 640, 512, 480, 4), ("yellow", "2023-08", 160, 150, 120, 2)])
    t = RP.run_totals(m).collect()[0]
    assert (t.months_processed, t.raw_rows, t.feature_rows, t.overall_retention_pct) == (2, 800, 600, 75.0)
    o = {r.file_month: r.retention_pct for r in RP.month_overview(m).collect()}
    assert o == {"2023-07": 75.0, "2023-08": 75.0}


def test_empty_run(spark):
    m = months(spark, [])
    t = RP.run_totals(m).collect()[0]
    assert (t.months_processed, t.raw_rows, t.overall_retention_pct) == (0, 0, None)


def test_empty_month_pct(spark):
    m = months(spark, [("yellow", "2024-01", 0, 0, 0, 0)])
    v = RP.validation_report(m).collect()[0]
    assert v.valid_pct is None                                    # H6: no division error
    t = RP.transform_report(m, ["a"]).collect()[0]
    assert t.output_pct == 0.0


def test_summary_and_digest(spark):
    """Two taxi types of one month stay apart everywhere."""
    m = months(spark, [("yellow", "2023-07", 640, 512, 480, 4), ("green", "2023-07", 50, 20, 10, 1)])
    f = spark.createDataFrame([("yellow", "2023-07", "RatecodeID:isin", 90), ("yellow", "2023-07", "extra:not_nullable", 38),
                               ("green", "2023-07", "RatecodeID:isin", 30)],
                              "taxi_type string, file_month string, rule string, n bigint")
    d = spark.createDataFrame([("yellow", "2023-07", "duration_too_long", 32), ("yellow", "2023-07", "non_positive_fare", 0),
                               ("green", "2023-07", "duration_too_long", 10)],
                              "taxi_type string, file_month string, reason string, n bigint")
    doc = json.loads(RP.run_summary(m, f, d, ["p"]).collect()[0].summary_json)
    assert doc["totals"] == {"raw_rows": 690, "feature_rows": 490, "overall_retention_pct": 71.0145}
    green, yellow = doc["months"]
    assert (green["taxi_type"], yellow["taxi_type"]) == ("green", "yellow")
    assert yellow["validation"]["valid_rows"] == 512 and yellow["transform"]["output_rows"] == 480
    assert yellow["validation"]["failure_counts"] == {"RatecodeID:isin": 90, "extra:not_nullable": 38}
    dig = {(r.taxi_type, r.section, r.item): r.value for r in RP.dq_digest(m, f, d).collect()}
    assert dig[("yellow", "top_quarantine_reason", "RatecodeID:isin")] == 90.0
    assert dig[("green", "top_quarantine_reason", "RatecodeID:isin")] == 30.0
    assert ("yellow", "top_outlier_reason", "non_positive_fare") not in dig      # zeros dropped
    assert dig[("yellow", "retention", "retention_pct")] == 75.0
    assert dig[("green", "validation", "valid_pct")] == 40.0
    assert {(r.taxi_type, r.retention_pct) for r in RP.month_overview(m).collect()} == {("yellow", 75.0), ("green", 20.0)}
