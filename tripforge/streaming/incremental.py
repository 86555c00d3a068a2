"""S4/S6 as a stream: load only months whose files have not been processed.

The reference keeps a manifest of ingested months and skips them on rerun.
In Spark the file source of Structured Streaming already records every file
it has processed in its checkpoint (an exactly-once log on the shared file
system), so an ``availableNow`` trigger over the landing zone processes new
files only, then stops - a scheduled incremental batch job.

Each micro-batch only *names* the months it touched (a distinct over two
partition columns, bounded by the number of months); those months are then
re-run whole from the landing zone with ``run_months``, whose month-level
replace makes a retried batch idempotent.  A month whose files arrive over
several batches is therefore always rebuilt from all of its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.config import DEFAULT_THRESHOLDS, Thresholds
from tripforge.plans.pipeline import run_months
from tripforge.sources.landing import record
from tripforge.sources.trips import PARTITION_COLS, read_landed


def landing_schema(spark: SparkSession, landing_root: str) -> T.StructType:
    """Schema of the landing zone (streaming file sources need one up front)."""
    return spark.read.parquet(landing_root).schema


def _manifest_entries(spark: SparkSession, landing_root: str, result, columns: list[str]) -> DataFrame:
    """S5 rows for the months a batch loaded: rows from the run's statistics,
    bytes from a content-free listing of the month directories."""
    months = result.months.select("taxi_type", F.col("file_month").alias("month"), "raw_rows")
    sizes = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(landing_root)
             .select(F.regexp_extract("path", r"taxi_type=([^/]+)", 1).alias("taxi_type"),
                     F.regexp_extract("path", r"file_month=(\d{4}-\d{2})", 1).alias("month"), "length")
             .groupBy("taxi_type", "month").agg(F.sum("length").alias("size_bytes")))
    cols = F.array(*[F.lit(c) for c in columns])
    return (months.join(sizes, ["taxi_type", "month"], "left")
                  .select("month", "taxi_type",
                          F.concat(F.lit(f"{landing_root}/taxi_type="), F.col("taxi_type"),
                                   F.lit("/file_month="), F.col("month")).alias("file"),
                          "size_bytes", F.col("raw_rows").alias("row_count"),
                          cols.alias("columns"), F.localtimestamp().alias("ingested_at")))


def incremental_load(spark: SparkSession, landing_root: str, out_root: str,
                     checkpoint: str | None = None, schema: T.StructType | None = None,
                     thresholds: Thresholds = DEFAULT_THRESHOLDS,
                     max_files_per_trigger: int | None = None,
                     manifest_path: str | None = None) -> list[list[tuple[str, str]]]:
    """Process every landed file not seen before; returns the months per batch.

    The stream's checkpoint (its record of processed files) defaults to a
    fixed place beside the outputs, so every later run resumes from it.  With
    ``manifest_path`` each loaded month is also appended to the manifest
    table (S5: latest recording per month wins)."""
    checkpoint = checkpoint or f"{out_root.rstrip('/')}/_checkpoints/incremental"
    schema = schema or landing_schema(spark, landing_root)
    reader = spark.readStream.schema(schema).option("basePath", landing_root)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(landing_root)
    processed: list[list[tuple[str, str]]] = []

    def batch(df: DataFrame, epoch_id: int) -> None:
        touched = sorted({(r[0], r[1]) for r in
                          df.select(*[F.col(c).cast("string") for c in PARTITION_COLS])
                            .distinct().collect()})
        if not touched:
            return
        raw = read_landed(spark, landing_root)
        result = run_months(spark, raw, out_root, touched, thresholds=thresholds)
        if manifest_path:
            data_cols = [c for c in raw.columns if c not in PARTITION_COLS]
            record(_manifest_entries(spark, landing_root, result, data_cols), manifest_path)
        processed.append(touched)

    q = (stream.writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return processed
