"""Sinks (S8-S11) with month-level replace semantics.

Layout (all under one output root on the shared file system):

  validated/_dq_status=valid/taxi_type=T/file_month=M/_outlier=B/      (S8)
  quarantine/taxi_type=T/file_month=M/                                 (S9)
  features/taxi_type=T/file_month=M/pickup_date=D/                     (S10)
  accounting/taxi_type=T/file_month=M/                                 (A6, A7)
  reports/<name>/run_id=R/                                             (S11)

Valid and quarantined rows are written by ONE job from ONE scan (the status
is a partition column, no shuffle).  Because every task that met a bad row
leaves a small quarantine file, the run's quarantine rows (a tiny fraction)
are then rewritten into their own month-partitioned table with AQE-sized
files and the scattered ones removed.  The valid rows that the outlier rules
drop lie in their own partition, so that the feature write reads the others
only and the drop counts read just the dropped.  Writes use dynamic partition
overwrite (each partition that receives rows is replaced at commit); the
pipeline then removes the run's partitions that received no rows
(``remove_stale_partitions``), so a rerun never appends, never keeps a stale
quarantine (H11) and never leaves a month missing mid-run.
"""

from __future__ import annotations

from typing import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.operators.quarantine import BAD_COL, REASONS_COL

STATUS_COL = "_dq_status"
RUN_COL = "_run_id"
OUTLIER_COL = "_outlier"      # 'true' / 'false'; 'false' on quarantined rows
VALID, QUARANTINED = "valid", "quarantined"
FEATURE_PARTITIONS = ("taxi_type", "file_month", "pickup_date")
MONTH_PARTITIONS = ("taxi_type", "file_month")
RATIO_COLUMNS = ("trip_speed_mph", "fare_per_mile", "tip_pct", "cost_per_min")


def _fs_delete(spark: SparkSession, path: str) -> None:
    """Recursive delete through the Hadoop FileSystem of the path (any store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if fs.exists(p):
        fs.delete(p, True)


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).exists(p))


def _fs_list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty when it does not exist)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file whole."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """A small file, replacing the one there unless ``overwrite`` is off."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def remove_stale_partitions(spark: SparkSession, parent: str, column: str, keep: set[str]) -> list[str]:
    """Delete ``parent/column=value`` directories whose value is not in ``keep``.

    Used after a dynamic-overwrite write: partitions that received rows were
    replaced at commit; those of the same months that received none are
    stale and are removed, so nothing is ever missing in between."""
    removed = []
    for name in _fs_list_dirs(spark, parent):
        if name.startswith(column + "=") and name[len(column) + 1:] not in keep:
            _fs_delete(spark, f"{parent}/{name}")
            removed.append(name)
    return removed


def clear_months(spark: SparkSession, root: str, prefixes: Sequence[str],
                 months: Iterable[tuple[str, str]]) -> None:
    """Remove ``root/<prefix>/taxi_type=T/file_month=M`` for each (T, M)."""
    for taxi_type, month in months:
        for pre in prefixes:
            base = f"{root}/{pre}" if pre else root
            _fs_delete(spark, f"{base}/taxi_type={taxi_type}/file_month={month}")


def write_validated(tagged: DataFrame, root: str, run_id: str | None = None) -> None:
    """S8+S9 in one write: valid rows, apart from those that are outliers
    (``_outlier``, if ``tagged`` has it), and quarantined rows (with reasons).

    ``run_id`` stamps the rows (a constant column, dictionary-encoded to
    almost nothing) so that statistics can tell this run's partitions from
    stale ones before those are removed."""
    status = F.when(F.col(BAD_COL), F.lit(QUARANTINED)).otherwise(F.lit(VALID))
    fate = F.col(OUTLIER_COL) if OUTLIER_COL in tagged.columns else F.lit(False)
    rows = [c for c in tagged.columns if c not in (BAD_COL, OUTLIER_COL)]
    stamp = [F.lit(run_id).alias(RUN_COL)] if run_id is not None else []
    (tagged.select(*[F.col("`" + c.replace("`", "``") + "`") for c in rows], *stamp, status.alias(STATUS_COL),
                   (~F.col(BAD_COL) & fate).cast("string").alias(OUTLIER_COL))
           .write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")
           .partitionBy(*VALIDATED_PARTITIONS)
           .parquet(root))


def with_partitions_last(schema: T.StructType, partition_cols: Sequence[str]) -> T.StructType:
    """Schema as Spark reads a partitioned table back: data, then partitions."""
    data = [f for f in schema.fields if f.name not in partition_cols]
    parts = [T.StructField(c, T.StringType(), True) for c in partition_cols]
    return T.StructType(data + parts)


VALIDATED_PARTITIONS = (STATUS_COL, "taxi_type", "file_month", OUTLIER_COL)


def validated_schema(raw_schema: T.StructType, with_run_id: bool = True) -> T.StructType:
    fields = [f for f in raw_schema.fields if f.name not in (BAD_COL, REASONS_COL, RUN_COL, OUTLIER_COL)]
    fields.append(T.StructField(REASONS_COL, T.StringType(), True))
    if with_run_id:
        fields.append(T.StructField(RUN_COL, T.StringType(), True))
    return with_partitions_last(T.StructType(fields), VALIDATED_PARTITIONS)


def _read_partitioned(spark: SparkSession, path: str, base: str,
                      schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("basePath", base)
    if schema is not None:
        # explicit schema: an empty output reads as an empty table (no
        # inference over zero files) and partition values stay strings
        reader = reader.schema(schema)
    df = reader.parquet(path)
    # Partition values are text in the contract (no DATE inference)
    for c in ("taxi_type", "file_month", "pickup_date", STATUS_COL, OUTLIER_COL):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("string"))
    return df


def read_validated(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    return _read_partitioned(spark, root, root, schema)


def read_valid(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """S8 read-back: valid rows without the reason column.

    A filter on the status partition column prunes the quarantine at listing
    time, so this reads exactly the valid files."""
    df = read_validated(spark, root, schema)
    return df.filter(F.col(STATUS_COL) == VALID).drop(STATUS_COL, REASONS_COL, RUN_COL, OUTLIER_COL)


def read_quarantine(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """S9 read-back: quarantined rows with ``_quarantine_reasons`` (may be empty)."""
    df = read_validated(spark, root, schema)
    return df.filter(F.col(STATUS_COL) == QUARANTINED).drop(STATUS_COL, RUN_COL, OUTLIER_COL)


TARGET_PARTITION_BYTES = 64 * 1024 * 1024   # of estimated (compressed, file-based) input


def plan_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate of a plan (from file sizes; runs no job)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate unavailable: fall back to defaults
        return 0


def shuffle_partitions_for(df: DataFrame, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Initial partition count for a shuffle of ``df``: one per ``target_bytes``
    of estimated input, at least the cluster's parallelism.  AQE coalesces the
    result down to its advisory size, so over-estimating is cheap; a fixed
    ``spark.sql.shuffle.partitions`` would give a few huge tasks at scale."""
    spark = df.sparkSession
    floor = max(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    est = plan_bytes(df)
    # no statistics -> Spark reports ~Long.MAX_VALUE (spark.sql.defaultSizeInBytes)
    if est <= 0 or est >= int(spark.conf.get("spark.sql.defaultSizeInBytes", str(2 ** 63 - 1))) // 2:
        return floor
    n = -(-est // target_bytes)
    return int(max(floor, n))


def write_features(rows: DataFrame, root: str,
                   derive: Callable[[DataFrame], DataFrame] | None = None) -> T.StructType:
    """Day-partitioned feature table; returns its schema as it is read back.

    ``rebalance`` on the partition keys lets AQE size the write tasks: small
    days are coalesced into one file, a huge day is split across tasks.  The
    initial partition count follows the input size (``shuffle_partitions_for``).
    ``derive`` adds columns after the shuffle, so that those need not be moved."""
    n = shuffle_partitions_for(rows)
    dealt = rows.hint("rebalance", n, *FEATURE_PARTITIONS)
    out = derive(dealt) if derive else dealt
    # ratios hardly repeat: a dictionary of them is built only to be thrown away
    ratios = {f"parquet.enable.dictionary#{c}": "false" for c in RATIO_COLUMNS if c in out.columns}
    (out.write.mode("overwrite").options(**ratios)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*FEATURE_PARTITIONS)
        .parquet(root))
    return with_partitions_last(out.schema, FEATURE_PARTITIONS)


def quarantine_schema(raw_schema: T.StructType) -> T.StructType:
    fields = [f for f in raw_schema.fields if f.name not in (BAD_COL, REASONS_COL, STATUS_COL, RUN_COL, OUTLIER_COL)]
    fields.append(T.StructField(REASONS_COL, T.StringType(), True))
    return with_partitions_last(T.StructType(fields), MONTH_PARTITIONS)


def write_quarantine(quarantined: DataFrame, root: str) -> None:
    """S9 compacted: quarantined rows of the run's months as a month-partitioned
    table.  The validation write has no shuffle, so every task that met a bad
    row left a tiny file; this (tiny) rewrite lets AQE size the files."""
    (quarantined.hint("rebalance", shuffle_partitions_for(quarantined), *MONTH_PARTITIONS)
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(*MONTH_PARTITIONS).parquet(root))


def read_quarantine_table(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    return _read_partitioned(spark, root, root, schema)


def read_features(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    return _read_partitioned(spark, root, root, schema)


ACCOUNTING_SCHEMA = T.StructType([
    T.StructField(name, T.LongType() if name == "n" else T.StringType())
    for name in ("pickup_date", "kind", "key", "n", *MONTH_PARTITIONS)])


def write_accounting(stats: DataFrame, root: str) -> None:
    """The counters of a run, months x (days + rules + reasons) rows, kept for
    each month: a rerun replaces its months' and leaves the others' alone."""
    (stats.select(*ACCOUNTING_SCHEMA.names).repartition(*MONTH_PARTITIONS)
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(*MONTH_PARTITIONS).parquet(root))


def read_accounting(spark: SparkSession, root: str) -> DataFrame:
    return _read_partitioned(spark, root, root, ACCOUNTING_SCHEMA)


def write_report(report: DataFrame, path: str) -> None:
    """A (tiny, bounded) report relation as JSON, replacing ``path``."""
    report.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
