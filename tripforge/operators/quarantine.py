"""Contract evaluation and the valid / quarantine split.

All rules are evaluated on every row and every failure is kept.  The
per-row work is one projection of boolean predicates; the reason text is a
``concat_ws`` of ``when``s evaluated only for failing rows, and the long
one-row-per-violation form is built only after the bad-row filter.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.functions import rules as R
from tripforge.functions.contract import TRIP_CONTRACT, Contract

REASONS_COL = "_quarantine_reasons"
BAD_COL = "_is_quarantined"


def active_rules(df: DataFrame, contract: Contract) -> list[R.Rule]:
    rules = R.applicable(contract.rules, df.columns)
    for r in contract.rules:
        # The cross-column temporal rule cannot be skipped silently: without
        # both timestamps there is nothing to validate.
        if r.kind == "before" and r not in rules:
            missing = [c for c in r.columns() if c not in df.columns]
            raise ValueError(f"rule {r.key} needs missing column(s) {missing}")
    return rules


def is_bad(df: DataFrame, contract: Contract = TRIP_CONTRACT) -> Column:
    """TRUE when the row violates at least one rule (never NULL)."""
    return R.any_bad(active_rules(df, contract))


def reasons(df: DataFrame, contract: Contract = TRIP_CONTRACT) -> Column:
    """``column:check=value`` for every violated rule, in rule order."""
    return R.reasons_column(active_rules(df, contract), df.schema)


def tag_violations(df: DataFrame, contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """Add ``_is_quarantined`` and ``_quarantine_reasons`` (NULL on valid rows)."""
    bad = is_bad(df, contract)
    return (df.withColumn(BAD_COL, bad)
              .withColumn(REASONS_COL, F.when(F.col(BAD_COL), reasons(df, contract))))


def valid_rows(df: DataFrame, contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """Rows with no violation; no reason column."""
    return df.filter(~is_bad(df, contract))


def quarantine_rows(df: DataFrame, contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """Violating rows with ``_quarantine_reasons``."""
    return (df.filter(is_bad(df, contract))
              .withColumn(REASONS_COL, reasons(df, contract)))


def split(df: DataFrame, contract: Contract = TRIP_CONTRACT) -> tuple[DataFrame, DataFrame]:
    return valid_rows(df, contract), quarantine_rows(df, contract)


def violations(df: DataFrame, id_cols: Sequence[str],
               contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """C33 long form: one row per (row id, violated rule).

    Only bad rows reach the explode.  The violated rule numbers travel as one
    ``concat_ws`` string that is split and exploded (flat, cheap to compile);
    rule names come from constant arrays indexed by rule number."""
    rules = active_rules(df, contract)
    codes = R.violated_codes(rules)
    col_names = "array(" + ", ".join(R.sql_literal(r.column) for r in rules) + ")"
    check_names = "array(" + ", ".join(R.sql_literal(r.check) for r in rules) + ")"
    ids = [R.ident(c) for c in id_cols]
    return (df.filter(is_bad(df, contract))
              .select(*id_cols, F.explode(F.split(codes, ",")).alias("_c"))
              .selectExpr(*ids, "CAST(_c AS INT) AS rule_no",
                          f"element_at({col_names}, CAST(_c AS INT)) AS column_name",
                          f"element_at({check_names}, CAST(_c AS INT)) AS check_name"))


def rule_hits(df: DataFrame, group_cols: Sequence[str] = (),
              contract: Contract = TRIP_CONTRACT, only_positive: bool = False) -> DataFrame:
    """Count of rows violating each rule (zeros kept unless ``only_positive``).

    One aggregate with a ``count_if`` per rule (partial aggregation on the map
    side, tiny shuffle), then an ``inline`` turns the wide row into rows."""
    rules = active_rules(df, contract)
    aggs = R.count_exprs(rules, "_n")
    wide = df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)
    entries = "inline(array(" + ", ".join(
        f"named_struct('rule_no', {i + 1}, 'rule', {R.sql_literal(r.key)}, "
        f"'column_name', {R.sql_literal(r.column)}, 'check_name', {R.sql_literal(r.check)}, 'n', _n{i})"
        for i, r in enumerate(rules)) + "))"
    out = wide.selectExpr(*[R.ident(c) for c in group_cols], entries)
    if only_positive:
        out = out.filter(F.col("n") > 0)
    return out


def failure_counts(df: DataFrame, group_cols: Sequence[str] = ("file_month",),
                   contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """A1: failures per ``column:check`` (only keys with at least one hit).

    Valid rows hit no rule, so callers may pass only the quarantined rows."""
    return (rule_hits(df, group_cols, contract, only_positive=True)
            .select(*group_cols, "rule", "n"))


def schema_drift(df: DataFrame, contract: Contract = TRIP_CONTRACT) -> DataFrame:
    """Missing / mistyped / extra columns versus the contract.

    Names are compared exactly (Spark resolves case-insensitively, the
    contract does not).  Row results are unaffected; this only reports."""
    spark = df.sparkSession
    actual = {f.name: f.dataType for f in df.schema.fields}
    expected = {f.name: f.dataType for f in contract.expected.fields}
    rows = []
    for name, dtype in expected.items():
        if name not in actual:
            rows.append((name, "missing", dtype.simpleString(), None))
        elif actual[name] != dtype:
            rows.append((name, "wrong_type", dtype.simpleString(), actual[name].simpleString()))
    for name, dtype in actual.items():
        if name not in expected:
            rows.append((name, "extra", None, dtype.simpleString()))
    schema = T.StructType([
        T.StructField("column_name", T.StringType()),
        T.StructField("issue", T.StringType()),
        T.StructField("expected", T.StringType()),
        T.StructField("actual", T.StringType()),
    ])
    return spark.createDataFrame(rows, schema)
