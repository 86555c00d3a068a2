"""Coercion, feature derivation and outlier filtering."""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.config import DEFAULT_THRESHOLDS, Thresholds
from tripforge.functions.coerce import coerce_exprs, coerce_sql
from tripforge.functions.features import PICKUP_DATE, feature_exprs, feature_sql
from tripforge.functions.outliers import any_outlier_sql, outlier_sql
from tripforge.functions.rules import ABSENT_COL


def coerce_types(df: DataFrame) -> DataFrame:
    """T1-T4 as one projection; absent columns are skipped."""
    return df.selectExpr(*coerce_sql(df.schema))


def add_features(df: DataFrame) -> DataFrame:
    """F1-F13 appended after the existing columns; one that is there already is kept."""
    return df.selectExpr("*", *feature_sql(df.columns))


def outlier_flags(df: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS,
                  keep: Sequence[str] | None = None) -> DataFrame:
    """One non-null boolean per outlier rule."""
    base = ["`" + c + "`" for c in (keep if keep is not None else df.columns)]
    flags = [f"coalesce({p}, FALSE) AS {name}" for name, p in outlier_sql(thresholds)]
    return df.selectExpr(*base, *flags)


def filter_outliers(df: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Drop a row when any rule holds (once, however many hold)."""
    return df.filter(f"NOT {any_outlier_sql(thresholds)}")


def is_outlier(thresholds: Thresholds = DEFAULT_THRESHOLDS):
    return F.expr(any_outlier_sql(thresholds))


def dropped_by_reason(df: DataFrame, group_cols: Sequence[str] = ("file_month",),
                      thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Rows violating each rule, counted independently; all keys present."""
    rules = outlier_sql(thresholds)
    aggs = [F.expr(f"count_if({p}) AS _o{i}") for i, (_, p) in enumerate(rules)]
    wide = df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)
    entries = "inline(array(" + ", ".join(
        f"named_struct('reason', '{name}', 'n', _o{i})" for i, (name, _) in enumerate(rules)) + "))"
    return wide.selectExpr(*["`" + c + "`" for c in group_cols], entries)


def build_features(valid: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Validated rows -> feature table rows (coerce, derive, drop outliers)."""
    return filter_outliers(featured(valid), thresholds)


def featured(valid: DataFrame) -> DataFrame:
    """Validated rows coerced and featured, before the outlier filter."""
    return add_features(coerce_types(valid.drop(ABSENT_COL)))


def outlier_of_raw_sql(df: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> str:
    """O1-O6 over the raw columns of ``df``: TRUE when its coerced, featured row is an outlier.

    The coercions and the features that the rules name are put in their place,
    so that a raw row can be told apart without carrying them along."""
    def put(text: str, by: dict[str, str]) -> str:
        return re.sub(r"`([^`]+)`", lambda m: by.get(m[1], m[0]), text)
    return put(put(any_outlier_sql(thresholds), feature_exprs(df.columns)), coerce_exprs(df.schema))


def keyed(valid: DataFrame) -> DataFrame:
    """Coerced rows with their partition day and no other feature yet: what a
    shuffle by day has to move (``add_features`` derives the rest after it)."""
    return coerce_types(valid.drop(ABSENT_COL)).selectExpr("*", f"{PICKUP_DATE} AS pickup_date")
