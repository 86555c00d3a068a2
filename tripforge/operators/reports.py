"""Report relations (A2-A7, R1-R4) built from the tiny pipeline statistics.

Inputs are the month / failure / drop relations of ``PipelineStats`` (or the
same shapes computed from written outputs), so none of these touches row
data: they are joins and aggregates over months x rules rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripforge.config import TOP_REASONS_LIMIT

MONTH_KEYS = ("taxi_type", "file_month")


def _pct(part, whole, digits=4):
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def top_reasons(counts: DataFrame, group_cols: Sequence[str], label_col: str,
                count_col: str = "n", k: int = TOP_REASONS_LIMIT) -> DataFrame:
    """Top-k labels per group, count desc then label asc, zeros removed.

    ``row_number() <= k`` over a partitioned window is planned as a
    WindowGroupLimit, so each task keeps at most k rows per group before the
    shuffle."""
    w = Window.partitionBy(*group_cols).orderBy(F.col(count_col).desc(), F.col(label_col).asc())
    return (counts.filter(F.col(count_col) > 0)
                  .withColumn("rank", F.row_number().over(w))
                  .filter(F.col("rank") <= k))


EMPTY_COUNTS = "CAST(map() AS MAP<STRING, BIGINT>)"


def month_rows(months: DataFrame, failures: DataFrame | None = None,
               drops: DataFrame | None = None) -> DataFrame:
    """Month accounting + ``failure_counts`` / ``dropped_by_reason`` maps:
    everything the per-month reports show, one row per month.  Worth
    materialising once when several reports are written."""
    rows = months
    if failures is not None and "failure_counts" not in rows.columns:
        fc = (failures.filter(F.col("n") > 0).groupBy(*MONTH_KEYS)
                      .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("rule", "n"))))
                           .alias("failure_counts")))
        rows = (rows.join(fc, list(MONTH_KEYS), "left")
                    .withColumn("failure_counts", F.coalesce("failure_counts", F.expr(EMPTY_COUNTS))))
    if drops is not None and "dropped_by_reason" not in rows.columns:
        dr = (drops.groupBy(*MONTH_KEYS)
                   .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n"))))
                        .alias("dropped_by_reason")))
        rows = rows.join(dr, list(MONTH_KEYS), "left")
    return rows


def _validation_cols() -> list:
    return [F.col("raw_rows").alias("total_rows"), "valid_rows", "quarantined_rows",
            _pct(F.col("valid_rows"), F.col("raw_rows")).alias("valid_pct"),
            _pct(F.col("quarantined_rows"), F.col("raw_rows")).alias("quarantined_pct")]


def _transform_cols(feature_columns: Sequence[str], with_drops: bool) -> list:
    """Transform report fields in report order (drop map between share and columns)."""
    cols = [F.col("valid_rows").alias("input_rows"), F.col("feature_rows").alias("output_rows"),
            "dropped_rows",
            F.coalesce(_pct(F.col("feature_rows"), F.col("valid_rows")), F.lit(0.0)).alias("output_pct")]
    if with_drops:
        cols.append("dropped_by_reason")
    cols.append(F.expr("array(" + ", ".join("'" + c.replace("'", "\\'") + "'" for c in feature_columns)
                       + ")").alias("feature_columns"))
    cols.append("n_partitions")
    return cols


def validation_report(months: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """A2: per month totals and shares (NULL shares on an empty month, H6)."""
    rows = month_rows(months, failures)
    extra = ["failure_counts"] if "failure_counts" in rows.columns else []
    return rows.select(*MONTH_KEYS, *_validation_cols(), *extra)


def transform_report(months: DataFrame, feature_columns: Sequence[str],
                     drops: DataFrame | None = None) -> DataFrame:
    """A3: input/output/dropped rows, output share (0.0 on empty input),
    distinct day partitions and the output column list."""
    rows = month_rows(months, None, drops)
    return rows.select(*MONTH_KEYS, *_transform_cols(feature_columns, "dropped_by_reason" in rows.columns))


def month_overview(months: DataFrame) -> DataFrame:
    """R2/A5: one overview row per taxi type and month."""
    return months.select(
        *MONTH_KEYS,
        F.coalesce("raw_rows", F.lit(0)).alias("raw_rows"),
        "valid_rows", "feature_rows",
        _pct(F.col("feature_rows"), F.col("raw_rows")).alias("retention_pct"),
    )


def run_totals(months: DataFrame) -> DataFrame:
    """Months processed, totals (NULL counts as 0) and overall retention."""
    t = months.agg(
        F.count(F.lit(1)).alias("months_processed"),
        F.coalesce(F.sum(F.coalesce("raw_rows", F.lit(0))), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.coalesce("feature_rows", F.lit(0))), F.lit(0)).alias("feature_rows"),
    )
    return t.select("*", _pct(F.col("feature_rows"), F.col("raw_rows")).alias("overall_retention_pct"))


def run_summary(months: DataFrame, failures: DataFrame | None, drops: DataFrame | None,
                feature_columns: Sequence[str]) -> DataFrame:
    """Nested run summary as one JSON document (one row).

    Per-month structs come from ``month_rows`` (no joins if it is already
    materialised); the month array is a ``collect_list`` over months - one
    element per processed month, a bounded list - sorted by month."""
    rows = month_rows(months, failures, drops)
    month_struct = F.struct(
        F.col("file_month").alias("month"), "taxi_type", "raw_rows", "valid_rows", "feature_rows",
        _pct(F.col("feature_rows"), F.col("raw_rows")).alias("end_to_end_retention_pct"),
        F.struct(*_validation_cols(), "failure_counts").alias("validation"),
        F.struct(*_transform_cols(feature_columns, True)).alias("transform"),
    )
    agg = rows.agg(
        F.count(F.lit(1)).alias("months_processed"),
        F.sum(F.coalesce("raw_rows", F.lit(0))).alias("raw_rows"),
        F.sum(F.coalesce("feature_rows", F.lit(0))).alias("feature_rows"),
        # maps are not orderable: sort the (few) month elements by their keys
        F.array_sort(F.collect_list(month_struct),
                     lambda a, b: F.when(a["month"] < b["month"], -1)
                                   .when(a["month"] > b["month"], 1)
                                   .when(a["taxi_type"] < b["taxi_type"], -1)
                                   .when(a["taxi_type"] > b["taxi_type"], 1).otherwise(0)).alias("months"),
    )
    doc = F.struct(
        "months_processed",
        F.struct("raw_rows", "feature_rows",
                 _pct(F.col("feature_rows"), F.col("raw_rows")).alias("overall_retention_pct"))
        .alias("totals"),
        "months",
    )
    return agg.select("months_processed", "raw_rows", "feature_rows",
                      F.to_json(doc, {"ignoreNullFields": "false"}).alias("summary_json"))


def dq_digest(months: DataFrame, failures: DataFrame, drops: DataFrame,
              k: int = TOP_REASONS_LIMIT) -> DataFrame:
    """The data-quality digest as a long relation (taxi type, month, section, item, value).

    Sections: validation numbers, top quarantine reasons, transform numbers,
    top outlier reasons, end-to-end retention (absent when undefined)."""
    items = [
        ("validation", "total_rows", F.col("raw_rows")),
        ("validation", "valid_rows", F.col("valid_rows")),
        ("validation", "quarantined_rows", F.col("quarantined_rows")),
        ("validation", "valid_pct", _pct(F.col("valid_rows"), F.col("raw_rows"), 2)),
        ("validation", "quarantined_pct", _pct(F.col("quarantined_rows"), F.col("raw_rows"), 2)),
        ("transform", "input_rows", F.col("valid_rows")),
        ("transform", "output_rows", F.col("feature_rows")),
        ("transform", "dropped_rows", F.col("dropped_rows")),
        ("transform", "output_pct",
         F.coalesce(_pct(F.col("feature_rows"), F.col("valid_rows"), 2), F.lit(0.0))),
        ("transform", "n_partitions", F.col("n_partitions")),
        ("retention", "retention_pct", _pct(F.col("feature_rows"), F.col("raw_rows"), 2)),
    ]
    # every per-month number in ONE projection over the month rows
    numbers = (months.select(*MONTH_KEYS, F.inline(F.array(*[
        F.struct(F.lit(sec).alias("section"), F.lit(name).alias("item"),
                 expr.cast("double").alias("value"))
        for sec, name, expr in items])))
        .filter((F.col("section") != "retention") | F.col("value").isNotNull()))
    tq = top_reasons(failures, MONTH_KEYS, "rule", k=k).select(
        *MONTH_KEYS, F.lit("top_quarantine_reason").alias("section"),
        F.col("rule").alias("item"), F.col("n").cast("double").alias("value"))
    to = top_reasons(drops, MONTH_KEYS, "reason", k=k).select(
        *MONTH_KEYS, F.lit("top_outlier_reason").alias("section"),
        F.col("reason").alias("item"), F.col("n").cast("double").alias("value"))
    return numbers.unionByName(tq).unionByName(to)
