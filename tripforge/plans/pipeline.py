"""B1: the end-to-end pipeline as a set-based job over all requested months.

    raw --(contract, outlier rules)--> validated/{valid kept, valid dropped,
                                       scattered quarantine}            job 1
    kept --(by day)--(features)--> features/day=...                     job 2
    scattered quarantine --(rebalance)--> quarantine/ table             job 3
    kept (2 columns), dropped (6), quarantine --> statistics            job 4 (checkpoint)
    statistics --> one per-month report relation --> three JSON reports

No per-month loop: months are a column.  Raw data is read, and the contract and
the outlier rules evaluated, once: job 1 deals every row to the partition that
tells its fate, and jobs 2 to 4, which run side by side, read only the
partitions they need.  The day shuffle of job 2 moves the coerced columns;
features are derived after it.  Row accounting: kept rows are counted by month
and day from their pickup time alone, drop reasons from the dropped rows;
failure counts re-evaluate the rules on the (small) quarantine.  Counts are never
taken with ``observe``/accumulators, whose map-stage updates can be applied
twice when a stage is retried after an executor loss.  Outputs are replaced
partition by partition (dynamic overwrite) and stale partitions of the run's
months are removed at the end.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.config import DEFAULT_THRESHOLDS, Thresholds
from tripforge.functions.contract import TRIP_CONTRACT, Contract
from tripforge.functions.coerce import coerce_exprs
from tripforge.functions.features import PICKUP
from tripforge.functions.outliers import outlier_sql
from tripforge.operators import quarantine as Q
from tripforge.operators import reports as RP
from tripforge.operators import transform as X
from tripforge.plans.accounting import MONTH_KEYS, fold
from tripforge.session import shared_root
from tripforge.sources import sinks as S
from tripforge.sources import snapshots as V
from tripforge.sources.trips import read_trips


@dataclass
class PipelineResult:
    out_root: str
    run_id: str
    months: DataFrame          # accounting per month
    failures: DataFrame        # per month x rule (positive only)
    drops: DataFrame           # per month x outlier reason (all reasons)
    validation: DataFrame
    transform: DataFrame
    skipped: tuple = ()        # (taxi_type, month, why) of landed months that could not be read

    versioned: bool = False    # tables lie in directories of this run
    schemas: dict = field(default_factory=dict)     # of the tables, as they are read back

    def _table(self, name: str) -> str:
        return f"{self.out_root}/{name}" + (f"/run={self.run_id}" if self.versioned else "")

    @property
    def validated_root(self) -> str:
        return self._table("validated")

    @property
    def features_root(self) -> str:
        return self._table("features")

    @property
    def quarantine_root(self) -> str:
        return self._table("quarantine")

    @property
    def accounting_root(self) -> str:
        return self._table("accounting")


def validate_stage(raw: DataFrame, validated_root: str, contract: Contract = TRIP_CONTRACT,
                   run_id: str | None = None, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> None:
    """The one pass over raw rows: contract, reasons and outlier rules.

    Two projections: the flags, then what is written by them (a projection for
    each added column would copy the wide row as often)."""
    flagged = raw.select("*", Q.is_bad(raw, contract).alias(S.BAD_COL),
                         F.expr(X.outlier_of_raw_sql(raw, thresholds)).alias(S.OUTLIER_COL))
    S.write_validated(flagged.withColumn(S.REASONS_COL, F.when(F.col(S.BAD_COL), Q.reasons(raw, contract))),
                      validated_root, run_id)


def transform_stage(spark: SparkSession, validated_root: str, features_root: str,
                    months: Sequence[tuple[str, str]],
                    thresholds: Thresholds = DEFAULT_THRESHOLDS,
                    validated_schema=None) -> DataFrame:
    valid = _only(S.read_valid(spark, validated_root, validated_schema), months)
    feats = X.build_features(valid, thresholds)
    S.write_features(feats, features_root)
    return feats


def _only(df: DataFrame, months: Sequence[tuple[str, str]]) -> DataFrame:
    """Partition filter on the months of this run (pruned at listing time)."""
    cond = None
    for t, m in months:
        c = (F.col("taxi_type") == t) & (F.col("file_month") == m)
        cond = c if cond is None else (cond | c)
    return df.filter(cond) if cond is not None else df


def run_months(spark: SparkSession, raw: DataFrame, out_root: str,
               months: Sequence[tuple[str, str]],
               contract: Contract = TRIP_CONTRACT,
               thresholds: Thresholds = DEFAULT_THRESHOLDS,
               write_reports: bool = True, versioned: bool = False) -> PipelineResult:
    """Run validate -> transform -> reports for ``months`` (taxi_type, month).

    ``raw`` must carry ``taxi_type`` and ``file_month``; rows of other months
    are ignored.  The month list is metadata (from the landing listing), it
    never comes from collecting data.  Independent jobs (the feature write
    and the statistics) are submitted concurrently.  ``versioned`` writes the
    tables to directories of this run, for ``publish_months``."""
    if not months:
        raise ValueError("no months to process")
    run_id = uuid.uuid4().hex[:12]
    shared_root(spark)  # checkpoint directory for the tiny statistics
    sub = f"/run={run_id}" if versioned else ""
    validated_root = f"{out_root}/validated{sub}"
    features_root = f"{out_root}/features{sub}"
    quarantine_root = f"{out_root}/quarantine{sub}"
    accounting_root = f"{out_root}/accounting{sub}"
    raw = _only(raw, months)
    # output schemas are known from the plan: reads never depend on inference
    v_schema = S.validated_schema(raw.schema)
    f_schema_box: list = []

    # Published outputs are never deleted up front: dynamic partition
    # overwrite replaces each partition that receives rows at job commit, and
    # partitions of these months that received none are removed afterwards
    # (``_remove_stale``), so a failure mid-run never leaves a month missing.
    def own_valid(outlier: bool | None = None) -> DataFrame:
        """This run's valid rows: a partition that got no rows this time still
        holds those of the run before until ``_remove_stale``."""
        rows = (_only(S.read_validated(spark, validated_root, v_schema), months)
                .filter((F.col(S.STATUS_COL) == S.VALID) & (F.col(S.RUN_COL) == run_id)))
        return rows if outlier is None else rows.filter(F.col(S.OUTLIER_COL) == str(outlier).lower())

    def validate_job() -> None:
        # the scattered quarantine files are an intermediate: start clean
        S.clear_months(spark, validated_root, [f"{S.STATUS_COL}={S.QUARANTINED}"], months)
        validate_stage(raw, validated_root, contract, run_id, thresholds)

    def features_job() -> None:
        kept = own_valid(False).drop(S.STATUS_COL, S.REASONS_COL, S.RUN_COL, S.OUTLIER_COL)
        f_schema_box.append(S.write_features(X.keyed(kept), features_root, X.add_features))

    def quarantine_job() -> None:
        # compact the scattered quarantine files of this run into their own table
        scattered = _only(S.read_quarantine(spark, validated_root, v_schema), months)
        S.write_quarantine(scattered, quarantine_root)

    def stats_job() -> DataFrame:
        """Every counter of the run in one checkpointed long relation
        (taxi_type, file_month, pickup_date, kind, key, n)."""
        def long(df: DataFrame, day: str, kind: str, key: str, n: str) -> DataFrame:
            return df.selectExpr(*MONTH_KEYS, f"{day} AS pickup_date", f"{kind} AS kind", f"{key} AS key", f"{n} AS n")
        none = "CAST(NULL AS STRING)"
        # valid and kept rows per (month, day): the pickup time is all that is read
        pickup = coerce_exprs(v_schema)[PICKUP]
        days = (own_valid().groupBy(*MONTH_KEYS, F.expr(f"CAST({pickup} AS DATE)").alias("_d"))
                .agg(F.count(F.lit(1)).alias("v"), F.count_if(F.col(S.OUTLIER_COL) == "false").alias("k"))
                .selectExpr(*MONTH_KEYS, "date_format(_d, 'yyyy-MM-dd') AS day",
                            "inline(array(named_struct('kind', 'valid_rows', 'n', v), named_struct('kind', 'feature_rows', 'n', k)))"))
        parts = [long(days, "day", "kind", none, "n")]
        # drop reasons: only dropped rows break an outlier rule; a month without any keeps its zeros
        drops = X.dropped_by_reason(X.featured(own_valid(True)), list(MONTH_KEYS), thresholds)
        parts.append(long(drops, none, "'drop'", "reason", "n"))
        zeros = ", ".join(f"'{name}'" for name, _ in outlier_sql(thresholds))
        parts.append(long(own_valid().select(*MONTH_KEYS).distinct().selectExpr(*MONTH_KEYS, f"explode(array({zeros})) AS reason"),
                          none, "'drop'", "reason", "0L"))
        # quarantine: row count + exact per-rule counts (valid rows hit no rule)
        quarantine = _only(S.read_quarantine(spark, validated_root, v_schema), months)
        q_n = quarantine.groupBy(*MONTH_KEYS).agg(F.count(F.lit(1)).alias("n"))
        parts.append(long(q_n, none, "'quarantined_rows'", none, "n"))
        fc = Q.failure_counts(quarantine.drop(S.REASONS_COL), list(MONTH_KEYS), contract)
        parts.append(long(fc, none, "'rule'", "rule", "n"))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.checkpoint(eager=True)

    validate_job()
    with ThreadPoolExecutor(max_workers=3) as pool:
        f_feat = pool.submit(features_job)
        f_quar = pool.submit(quarantine_job)
        stats = stats_job()
        f_quar.result()
        # the scattered files are in the compacted table and the statistics now
        S.clear_months(spark, validated_root, [f"{S.STATUS_COL}={S.QUARANTINED}"], months)
        f_feat.result()

    months_df, failures, drops = fold(stats)

    _remove_stale(spark, stats, months, validated_root, quarantine_root, features_root, accounting_root)

    feature_cols = [f.name for f in f_schema_box[0].fields]

    def month_path(root: str, prefix: str = "") -> "F.Column":
        return F.concat(F.lit(f"{root}/{prefix}taxi_type="), F.col("taxi_type"),
                        F.lit("/file_month="), F.col("file_month"))

    # every per-month report number and map, materialised once (tiny)
    rows = RP.month_rows(months_df, failures, drops).checkpoint(eager=True)
    validation = RP.validation_report(rows).select(
        "*", month_path(validated_root, f"{S.STATUS_COL}={S.VALID}/").alias("valid_path"),
        F.when(F.col("quarantined_rows") > 0, month_path(quarantine_root)).alias("quarantine_path"))
    transform = RP.transform_report(rows, feature_cols).select(
        "*", month_path(features_root).alias("output_path"))
    with ThreadPoolExecutor(max_workers=4) as pool:
        rep = f"{out_root}/reports"
        jobs = [(validation, f"{rep}/validation/run_id={run_id}"),
                (transform, f"{rep}/transform/run_id={run_id}"),
                (RP.run_summary(rows, None, None, feature_cols),
                 f"{rep}/run_summary/run_id={run_id}")]
        waits = [pool.submit(S.write_accounting, stats, accounting_root)]
        waits += [pool.submit(S.write_report, df, path) for df, path in (jobs if write_reports else [])]
        for f in waits:
            f.result()
    return PipelineResult(out_root, run_id, months_df, failures, drops, validation, transform, versioned=versioned,
                          schemas={"validated": v_schema, "quarantine": S.quarantine_schema(raw.schema),
                                   "features": f_schema_box[0], "accounting": S.ACCOUNTING_SCHEMA})


def publish_months(spark: SparkSession, raw: DataFrame, root: str, months: Sequence[tuple[str, str]],
                   contract: Contract = TRIP_CONTRACT, thresholds: Thresholds = DEFAULT_THRESHOLDS,
                   ) -> tuple[PipelineResult, V.Snapshot]:
    """``run_months`` into directories of its own, then all months published at once.

    Readers (``snapshots.read``) see the months as they were up to the commit and
    as this run left them from it on.  A run that fails, or finds one of its months
    published by another meanwhile (``SnapshotConflict``), publishes nothing; what
    the latter wrote is removed."""
    base = V.load(spark, root)
    result = run_months(spark, raw, root, months, contract, thresholds, versioned=True)
    counts = {(r.taxi_type, r.file_month): r for r in result.months.collect()}      # a row a month

    def entry(key: tuple[str, str]) -> dict:
        r = counts.get(key)
        rows = (r.valid_rows, r.quarantined_rows, r.feature_rows, 1) if r else (0, 0, 0, 0)
        return {"run": result.run_id, "rows": dict(zip(V.TABLES, rows))}
    try:
        snapshot = V.commit(spark, root, base, {V.month_key(*k): entry(k) for k in months},
                            {result.run_id: {t: s.jsonValue() for t, s in result.schemas.items()}})
    except V.SnapshotConflict:
        V.discard(spark, root, result.run_id)
        raise
    return result, snapshot


def stored_totals(spark: SparkSession, out_root: str, snapshot: V.Snapshot | int | None = None,
                  versioned: bool = False) -> DataFrame:
    """A7 over every month ever run into ``out_root``, from the stored counters:
    a new month adds its own and no data file of another is read."""
    stats = V.read(spark, out_root, "accounting", snapshot) if versioned else S.read_accounting(spark, f"{out_root}/accounting")
    return RP.run_totals(fold(stats)[0])


def _remove_stale(spark: SparkSession, stats: DataFrame, months: Sequence[tuple[str, str]],
                  validated_root: str, quarantine_root: str, features_root: str, accounting_root: str) -> None:
    """Delete partitions of the run's months that this run wrote no rows to.

    What was written is read from the (checkpointed, months x days sized)
    statistics, never by listing data files."""
    present = (stats.filter(F.col("kind").isin("valid_rows", "quarantined_rows", "feature_rows", "drop")
                            & (F.col("n") > 0))
                    .select(*MONTH_KEYS, "pickup_date", "kind").distinct().collect())
    valid = {(r.taxi_type, r.file_month) for r in present if r.kind == "valid_rows"}
    quarantined = {(r.taxi_type, r.file_month) for r in present if r.kind == "quarantined_rows"}
    days: dict[tuple[str, str], set[str]] = {}
    for r in present:
        if r.kind == "feature_rows":
            days.setdefault((r.taxi_type, r.file_month), set()).add(r.pickup_date)
    dropped = {(r.taxi_type, r.file_month) for r in present if r.kind == "drop"}
    for t, m in months:
        if (t, m) not in valid:
            S.clear_months(spark, validated_root, [f"{S.STATUS_COL}={S.VALID}"], [(t, m)])
        else:
            fates = {f for f, has in (("false", days), ("true", dropped)) if (t, m) in has}
            S.remove_stale_partitions(spark, f"{validated_root}/{S.STATUS_COL}={S.VALID}/taxi_type={t}/file_month={m}",
                                      S.OUTLIER_COL, fates)
        if (t, m) not in quarantined:
            S.clear_months(spark, quarantine_root, [""], [(t, m)])
        if (t, m) not in valid | quarantined:
            S.clear_months(spark, accounting_root, [""], [(t, m)])
        S.remove_stale_partitions(spark, f"{features_root}/taxi_type={t}/file_month={m}",
                                  "pickup_date", days.get((t, m), set()))


def run_files(spark: SparkSession, paths: Iterable[str], out_root: str,
              thresholds: Thresholds = DEFAULT_THRESHOLDS) -> PipelineResult:
    """Run the pipeline over flat monthly files; months come from file names."""
    from tripforge.sources.trips import parse_file_name
    paths = list(paths)
    months = sorted({parse_file_name(p.rstrip("/").rsplit("/", 1)[-1]) for p in paths})
    return run_months(spark, read_trips(spark, paths), out_root, months, thresholds=thresholds)


def run_range(spark: SparkSession, landing_root: str, out_root: str, start: str, end: str,
              thresholds: Thresholds = DEFAULT_THRESHOLDS, fail_fast: bool = False,
              taxi_type: str = "yellow", versioned: bool = False) -> PipelineResult | None:
    """``run --start --end``: every landed month of the inclusive range in one
    set-based job.  Months that are missing, or whose files cannot be read, are
    skipped (the latter are named in ``skipped``), or raise with ``fail_fast``.

    A file may also break while its rows are read: nothing is published then
    (raw rows are read by the first write alone, which commits whole), the units
    are audited and the run goes on without the months that hold a broken file.
    Only the list of available months (bounded by the requested range) and
    their schemas reach the driver."""
    from tripforge.sources.landing import audit_units, availability, landing_listing, month_range
    from tripforge.sources.trips import Unit, read_units, unit_schemas
    req = month_range(spark, start, end).withColumn("taxi_type", F.lit(taxi_type))
    # which months exist is a content-free file listing, not a scan of the data
    landed = landing_listing(spark, landing_root).select("taxi_type", "month", "path")
    avail = availability(req, landed, fail_fast=fail_fast).filter(F.col("status") == "ok")
    units = [Unit(r.path, r.taxi_type, r.month) for r in
             landed.join(avail, ["taxi_type", "month"], "left_semi").select("path", "taxi_type", "month").collect()]
    schemas = unit_schemas(spark, sorted(units))
    broken = {u: e for u, e in schemas.items() if isinstance(e, Exception)}
    if broken and fail_fast:
        raise next(iter(broken.values()))
    def whole_months(schemas: dict, broken: dict) -> dict:
        """Without the months that hold a broken unit: a month is run whole or not at all."""
        bad = {(u.taxi_type, u.month) for u in broken}
        return {u: s for u, s in schemas.items() if (u.taxi_type, u.month) not in bad}

    schemas, result = whole_months(schemas, broken), None
    while schemas:
        months = sorted({(u.taxi_type, u.month) for u in schemas})
        try:
            raw = read_units(spark, schemas)
            result = (publish_months(spark, raw, out_root, months, thresholds=thresholds)[0] if versioned else
                      run_months(spark, raw, out_root, months, thresholds=thresholds))
            break
        except V.SnapshotConflict:
            raise
        except Exception:
            failed = {} if fail_fast else audit_units(spark, schemas)
            if not failed:
                raise                                # not the files' fault, or not to be survived
            broken |= failed
            schemas = whole_months(schemas, failed)
    if result is not None:
        result.skipped = tuple((u.taxi_type, u.month, str(e).splitlines()[0]) for u, e in broken.items())
    return result
