"""Row accounting of the whole pipeline from ONE scan.

The contract, the coercion, the features and the outlier rules are all column
expressions, so every count the reports need is one aggregate over the raw
scan: a partial hash aggregate per task keyed by
(taxi_type, file_month, pickup_date) with 40 ``count_if`` counters shrinks the
data to months x days rows before the only shuffle.  Everything else (month
totals, failure counts, drop reasons, day-partition counts) is derived from
that tiny relation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.config import DEFAULT_THRESHOLDS, Thresholds
from tripforge.functions import rules as R
from tripforge.functions.contract import TRIP_CONTRACT, Contract
from tripforge.functions.outliers import any_outlier_sql, outlier_sql
from tripforge.operators import quarantine as Q
from tripforge.operators import transform as X

MONTH_KEYS = ("taxi_type", "file_month")


def pct(part, whole, digits: int = 4):
    """round(100 * part / whole, digits); NULL when whole is 0 (H6)."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


@dataclass
class PipelineStats:
    """Tiny relations every report is built from."""

    days: DataFrame       # taxi_type, file_month, pickup_date, raw/valid/feature rows
    failures: DataFrame   # taxi_type, file_month, rule_no, rule, n   (all rules, zeros kept)
    drops: DataFrame      # taxi_type, file_month, reason, n          (all reasons)

    def months(self) -> DataFrame:
        return month_totals(self.days)


def day_stats_wide(raw: DataFrame, contract: Contract = TRIP_CONTRACT,
                   thresholds: Thresholds = DEFAULT_THRESHOLDS) -> tuple[DataFrame, list, list]:
    rules = Q.active_rules(raw, contract)
    orules = outlier_sql(thresholds)
    # rule flags are evaluated on the raw columns, outlier flags on the coerced
    # + featured projection of the same row (only counted for valid rows)
    flagged = raw.select("*", R.any_bad(rules).alias("_bad"),
                         *[r.bad().alias(f"_r{i}") for i, r in enumerate(rules)])
    feats = X.featured(flagged)
    aggs = [F.expr("count(1) AS raw_rows"), F.expr("count_if(NOT _bad) AS valid_rows"),
            F.expr(f"count_if(NOT _bad AND NOT {any_outlier_sql(thresholds)}) AS feature_rows")]
    aggs += [F.expr(f"count_if(_r{i}) AS _r{i}") for i in range(len(rules))]
    aggs += [F.expr(f"count_if(NOT _bad AND {p}) AS _o{i}") for i, (_, p) in enumerate(orules)]
    wide = feats.groupBy(*MONTH_KEYS, "pickup_date").agg(*aggs)
    return wide, rules, orules


def stats_long(raw: DataFrame, contract: Contract = TRIP_CONTRACT,
               thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """(taxi_type, file_month, pickup_date, kind, key, n) for every counter.

    Every report branch filters this one relation, so all branches share an
    identical scan -> partial aggregate -> exchange subtree, which Spark
    reuses (per-branch column pruning of the wide aggregate would otherwise
    make each branch a different plan and re-scan the input)."""
    wide, rules, orules = day_stats_wide(raw, contract, thresholds)
    entries = [f"named_struct('kind', '{k}', 'key', CAST(NULL AS STRING), 'n', {k})"
               for k in ("raw_rows", "valid_rows", "feature_rows")]
    entries += [f"named_struct('kind', 'rule', 'key', {R.sql_literal(r.key)}, 'n', _r{i})"
                for i, r in enumerate(rules)]
    entries += [f"named_struct('kind', 'drop', 'key', '{name}', 'n', _o{i})"
                for i, (name, _) in enumerate(orules)]
    return wide.selectExpr(*MONTH_KEYS, "pickup_date", "inline(array(" + ", ".join(entries) + "))")


def pipeline_stats(raw: DataFrame, contract: Contract = TRIP_CONTRACT,
                   thresholds: Thresholds = DEFAULT_THRESHOLDS,
                   materialize: bool = False) -> PipelineStats:
    """All counters of a pipeline run in one scan of ``raw``.

    ``materialize`` checkpoints the tiny long relation into the shared
    checkpoint directory (cuts lineage; survives executor loss)."""
    long = stats_long(raw, contract, thresholds)
    if materialize:
        long = long.checkpoint(eager=True)
    kinds = ["raw_rows", "valid_rows", "feature_rows"]
    days = (long.filter(F.col("kind").isin(*kinds))
                .groupBy(*MONTH_KEYS, "pickup_date").pivot("kind", kinds).agg(F.sum("n")))
    rule_order = {r.key: i + 1 for i, r in enumerate(Q.active_rules(raw, contract))}
    failures = (long.filter(F.col("kind") == "rule")
                    .groupBy(*MONTH_KEYS, F.col("key").alias("rule")).agg(F.sum("n").alias("n")))
    order_map = "map(" + ", ".join(f"{R.sql_literal(k)}, {i}" for k, i in rule_order.items()) + ")"
    failures = failures.selectExpr(*MONTH_KEYS, f"element_at({order_map}, rule) AS rule_no", "rule", "n")
    drops = (long.filter(F.col("kind") == "drop")
                 .groupBy(*MONTH_KEYS, F.col("key").alias("reason")).agg(F.sum("n").alias("n")))
    return PipelineStats(days=days, failures=failures, drops=drops)


def fold(stats: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(months, failures, drops) of a run's counters (taxi_type, file_month,
    pickup_date, kind, key, n), of any months: counters of several runs over
    different months fold like those of one run."""
    kinds = ["valid_rows", "feature_rows", "quarantined_rows"]
    days = (stats.filter(F.col("kind").isin(*kinds))
                 .groupBy(*MONTH_KEYS, "pickup_date").pivot("kind", kinds).agg(F.sum("n"))
                 .na.fill(0, kinds))
    days = days.select(*MONTH_KEYS, "pickup_date",
                       (F.col("valid_rows") + F.col("quarantined_rows")).alias("raw_rows"),
                       "valid_rows", "feature_rows")
    failures = (stats.filter(F.col("kind") == "rule")
                     .select(*MONTH_KEYS, F.col("key").alias("rule"), "n"))
    drops = (stats.filter(F.col("kind") == "drop")
                  .groupBy(*MONTH_KEYS, F.col("key").alias("reason")).agg(F.sum("n").alias("n")))
    return month_totals(days), failures, drops


def month_totals(days: DataFrame) -> DataFrame:
    """Fold day rows into one accounting row per month."""
    m = days.groupBy(*MONTH_KEYS).agg(
        F.sum("raw_rows").alias("raw_rows"),
        F.sum("valid_rows").alias("valid_rows"),
        F.sum("feature_rows").alias("feature_rows"),
        F.count_if(F.col("feature_rows") > 0).alias("n_partitions"),
    )
    return accounting_rows(m)


def accounting_rows(m: DataFrame) -> DataFrame:
    """Derived accounting columns from raw / valid / feature rows + partitions."""
    feature = F.coalesce(F.col("feature_rows"), F.lit(0)).cast("long")
    return m.select(
        *MONTH_KEYS, "raw_rows", "valid_rows",
        (F.col("raw_rows") - F.col("valid_rows")).alias("quarantined_rows"),
        feature.alias("feature_rows"),
        (F.col("valid_rows") - feature).alias("dropped_rows"),
        F.coalesce(F.col("n_partitions"), F.lit(0)).cast("long").alias("n_partitions"),
        pct(feature, F.col("raw_rows")).alias("retention_pct"),
    )


def month_accounting(raw: DataFrame, contract: Contract = TRIP_CONTRACT,
                     thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """B1: one row per month: raw -> valid -> features with retention."""
    wide, _, _ = day_stats_wide(raw, contract, thresholds)
    return month_totals(wide.select(*MONTH_KEYS, "pickup_date", "raw_rows",
                                    "valid_rows", "feature_rows"))
