"""Incremental loading state: landing listing, manifest, month ranges.

Files are taken as already landed (no download).  The load decision is a
set operation: the content-free listing of the landing zone is held against the
manifest first, by a fingerprint of each month's files (paths, sizes, times), and
footers are read for new and changed months only.  The manifest is an
append-only table (one row per recording); its current state is the latest
row per (taxi_type, month), so concurrent recorders never lose updates (H17).
"""

from __future__ import annotations

import json
import re
import uuid
from datetime import datetime
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.session import shared_root
from tripforge.sources import sinks as S
from tripforge.sources.trips import FILE_RE_MONTH, FILE_RE_TYPE, Unit, unit_schemas

MANIFEST_SCHEMA = T.StructType([
    T.StructField("month", T.StringType(), False),
    T.StructField("taxi_type", T.StringType(), False),
    T.StructField("file", T.StringType(), True),
    T.StructField("size_bytes", T.LongType(), True),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("columns", T.ArrayType(T.StringType()), True),
    T.StructField("ingested_at", T.TimestampNTZType(), True),
    T.StructField("fingerprint", T.StringType(), True),
    T.StructField("seq", T.LongType(), True),           # of the recording, among those its writer saw
])
KEYS = ["taxi_type", "month"]
_MONTH = re.compile(r"^\d{4}-\d{2}$")


# -- S7: month ranges ----------------------------------------------------------

def _check_month(m: str) -> None:
    if not _MONTH.match(m):
        raise ValueError(f"month must be YYYY-MM, got {m!r}")
    datetime.strptime(m, "%Y-%m")


def month_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Inclusive YYYY-MM range (``pos``, ``month``); start after end is an error."""
    _check_month(start)
    _check_month(end)
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    return month_range_of(spark.range(1).select(F.lit(start).alias("s"), F.lit(end).alias("e")),
                          "s", "e")


def month_range_of(bounds: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """Months between two YYYY-MM columns of a one-row relation, inclusive."""
    s = F.to_date(F.concat(F.col(start_col), F.lit("-01")))
    e = F.to_date(F.concat(F.col(end_col), F.lit("-01")))
    seq = F.sequence(s, e, F.expr("INTERVAL 1 MONTH"))
    return (bounds.select(F.posexplode(seq).alias("pos", "d"))
                  .select("pos", F.date_format("d", "yyyy-MM").alias("month")))


def months_spanned(df: DataFrame, month_cols: Sequence[str]) -> DataFrame:
    """Every month from the earliest to the latest value of ``month_cols``."""
    mins, maxs = [F.min(c) for c in month_cols], [F.max(c) for c in month_cols]
    lo = F.least(*mins) if len(mins) > 1 else mins[0]
    hi = F.greatest(*maxs) if len(maxs) > 1 else maxs[0]
    return month_range_of(df.agg(lo.alias("s"), hi.alias("e")), "s", "e")


# -- S3: landing listing and per-file stats -----------------------------------

HIVE_UNIT_RE = r"^(.*/taxi_type=([^/]+)/file_month=(\d{4}-\d{2}))/[^/]+$"


def _unit(path: "F.Column", name: "F.Column") -> tuple:
    """(unit path, unit name) of a landed parquet file: a flat monthly file,
    the directory of part files named like one, or a Hive month directory."""
    hive = F.regexp_extract(path, HIVE_UNIT_RE, 1)
    is_file = name.contains("_tripdata_")
    unit_path = (F.when(hive != "", hive)
                  .when(is_file, path)
                  .otherwise(F.regexp_extract(path, r"^(.*)/[^/]+$", 1)))
    hive_name = F.concat(F.regexp_extract(path, HIVE_UNIT_RE, 2), F.lit("_tripdata_"),
                         F.regexp_extract(path, HIVE_UNIT_RE, 3), F.lit(".parquet"))
    unit_name = (F.when(hive != "", hive_name)
                  .when(is_file, name)
                  .otherwise(F.element_at(F.split(path, "/"), -2)))
    return unit_path, unit_name


def _listed(spark: SparkSession, roots: Iterable[str]) -> DataFrame:
    """(path, length, modificationTime) of parquet files; content is not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(list(roots))
            .select("path", "length", "modificationTime"))


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """Every landed file with its monthly unit (unit, file_name, path, length, modificationTime)."""
    unit_path, unit_name = _unit(F.col("path"), F.element_at(F.split("path", "/"), -1))
    return (_listed(spark, [root]).select(unit_path.alias("unit"), unit_name.alias("file_name"), "path", "length", "modificationTime")
            .filter(F.col("file_name").rlike(r"^[A-Za-z0-9]+_tripdata_\d{4}-\d{2}\.parquet$")))


def landing_listing(spark: SparkSession, root: str) -> DataFrame:
    """Landed monthly units (taxi_type, month, path, size, mtime, fingerprint); content is not read.

    A unit is a ``*_tripdata_YYYY-MM.parquet`` file, a directory of that name
    holding part files (what a Spark writer produces), or a Hive landing
    directory ``taxi_type=T/file_month=M``; sizes are summed per unit.  The
    fingerprint tells any added, removed or rewritten file, in whatever order
    the files are listed."""
    one = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    units = (landed_files(spark, root).groupBy(F.col("unit").alias("path"), "file_name")
             .agg(F.sum("length").alias("size_bytes"), F.max("modificationTime").alias("modificationTime"),
                  F.concat_ws("-", F.count(F.lit(1)), F.hex(F.bit_xor(one))).alias("fingerprint")))
    return units.select("path", "file_name", "size_bytes", "modificationTime", "fingerprint",
                        F.regexp_extract("file_name", FILE_RE_TYPE, 1).alias("taxi_type"),
                        F.regexp_extract("file_name", FILE_RE_MONTH, 1).alias("month"))


FOOTER = "path string, row_count bigint, columns array<string>, error string"


def _open_local_or_remote(path: str):
    """(pyarrow file system, path on it); listed paths are not percent-encoded."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    scheme, rest = path.split("://", 1)
    return fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{rest}")


def footers(files: DataFrame) -> DataFrame:
    """FOOTER of every file of ``files`` (path): its own row count and its own
    columns in order, empty files with 0.

    The paths are dealt to tasks, which read each footer by itself; ``error``
    says why one could not be read, the other columns are null then."""
    spark = files.sparkSession

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for b in batches:
            rows = []
            for path in b.column("path").to_pylist():
                try:
                    f, inner = _open_local_or_remote(path)
                    with f.open_input_file(inner) as file:
                        meta = pq.read_metadata(file)
                    rows.append((path, meta.num_rows, meta.schema.to_arrow_schema().names, None))
                except Exception as e:  # noqa: BLE001 - told apart by the caller
                    rows.append((path, None, None, f"{type(e).__name__}: {e}"[:500]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.list_(pa.string()), pa.string()))],
                ["path", "row_count", "columns", "error"]) if rows else pa.RecordBatch.from_pylist(
                [], pa.schema([("path", pa.string()), ("row_count", pa.int64()), ("columns", pa.list_(pa.string())), ("error", pa.string())]))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return files.select("path").repartition(parts).mapInArrow(read, FOOTER)


def footers_anyhow(files: DataFrame) -> DataFrame:
    """``footers``, and for files in a store that only Spark reaches Spark's own
    look at each (from the driver, a file at a time); what neither can read keeps its error."""
    spark = files.sparkSession
    shared_root(spark)
    got = footers(files).checkpoint(eager=True)               # a row a file, read once
    rows = []
    for r in got.filter("error IS NOT NULL").collect():
        try:
            df = spark.read.parquet(r.path)
            rows.append((r.path, df.count(), df.columns, None))
        except Exception as e:  # noqa: BLE001 - reported with the file
            rows.append((r.path, None, None, str(e).splitlines()[0][:500]))
    return got.filter("error IS NULL").unionByName(spark.createDataFrame(rows, FOOTER)) if rows else got


def file_stats(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """S3: (file_name, size_bytes, row_count, columns, error) of each parquet file
    under ``paths``, from its own footer; files may differ in their columns."""
    files = _listed(spark, paths)
    return (files.join(footers_anyhow(files), "path")
            .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("size_bytes"),
                    "row_count", "columns", "error"))


def unit_stats(spark: SparkSession, paths: Iterable[str], files: DataFrame | None = None) -> DataFrame:
    """(path, row_count, size_bytes, columns) per monthly unit (file or directory of parts).

    Columns are those of the unit's files in order of their first appearance; a
    unit with a file whose footer cannot be read has no row count."""
    if files is None:
        unit_path, _ = _unit(F.col("path"), F.element_at(F.split("path", "/"), -1))
        files = _listed(spark, paths).select(unit_path.alias("unit"), "path", "length")
    seen = files.select("unit", "path", "length").join(footers_anyhow(files), "path")
    return (seen.groupBy(F.col("unit").alias("path"))
            .agg(F.when(F.count("error") == 0, F.sum("row_count")).alias("row_count"), F.sum("length").alias("size_bytes"),
                 F.array_distinct(F.flatten(F.sort_array(F.collect_set("columns")))).alias("columns")))


# -- S5: manifest ---------------------------------------------------------------

def manifest_latest(manifest: DataFrame) -> DataFrame:
    """Current manifest: the last recording per (taxi_type, month) wins.

    Recordings of one instant go by their writer's sequence, and then by the other
    columns, so that every reader finds the same one whatever the order of files."""
    cols = manifest.columns
    first = [c for c in ("ingested_at", "seq") if c in cols]
    order = F.struct(*first, *[c for c in cols if c not in first])
    return manifest.groupBy(*KEYS).agg(F.max_by(F.struct(*cols), order).alias("e")).select("e.*")


def manifest_contains(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``keys`` (taxi_type, month) already present in the manifest."""
    return keys.join(manifest.select(*KEYS).distinct(), KEYS, "left_semi")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Append-only manifest table; empty when nothing was recorded yet."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    except Exception as e:  # noqa: BLE001 - absent table == empty manifest
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], MANIFEST_SCHEMA)
        raise


def _append(entries: DataFrame, path: str) -> None:
    """One file in a directory of its own: a recording is seen whole or not at
    all, and writers side by side have no output directory in common."""
    entries.select(*MANIFEST_SCHEMA.names).coalesce(1).write.parquet(f"{path}/entry-{uuid.uuid4().hex}")


def record(entries: DataFrame, path: str) -> None:
    """Append recordings (never rewrite history)."""
    if "fingerprint" not in entries.columns:
        entries = entries.withColumn("fingerprint", F.lit(None).cast("string"))
    last = read_manifest(entries.sparkSession, path).agg(F.max("seq")).first()[0] or 0
    _append(entries.withColumn("seq", F.lit(last + 1).cast("long")), path)


REPLACED = "_replaced.json"        # hidden from readers: files that the last compaction folded


def compact_manifest(spark: SparkSession, path: str) -> int:
    """Fold the manifest's files into one that holds the latest recording of each
    month; returns how many were folded.

    Only files listed at the start are folded, so recordings that arrive meanwhile
    stay.  The folded files are deleted by the next compaction: readers that began
    before this one still find them, and to have a recording twice changes nothing,
    also after a compaction that broke off."""
    if not S._fs_exists(spark, path):
        return 0
    files = sorted(r.path for r in _listed(spark, [path]).select("path").collect())
    marker = f"{path}/{REPLACED}"
    try:
        gone = set(json.loads(S.read_text(spark, marker))) & set(files) if S._fs_exists(spark, marker) else set()
    except ValueError:
        gone = set()                   # cut off while it was written: these files are folded anew
    live = [f for f in files if f not in gone]
    if len(live) > 1:
        _append(manifest_latest(spark.read.schema(MANIFEST_SCHEMA).parquet(*live)), path)
        S.write_text(spark, marker, json.dumps(live))
    else:
        S.write_text(spark, marker, "[]")
    for f in gone:
        parent = f.rsplit("/", 1)[0]
        # an entry's directory goes with its only file
        S._fs_delete(spark, parent if parent.rsplit("/", 1)[-1].startswith("entry-") else f)
    return len(live) if len(live) > 1 else 0


# -- S4/S6/B2: load decisions -------------------------------------------------------

def pending(landed: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """Landed (taxi_type, month) not yet in the manifest; all of them with force."""
    if force:
        return landed
    return landed.join(manifest.select(*KEYS), KEYS, "left_anti")


def ingest_plan(requested: DataFrame, landed: DataFrame, manifest: DataFrame,
                force: bool = False) -> DataFrame:
    """Per requested month (order kept): landed?, skipped?, rows, size."""
    known = manifest.select(*KEYS).distinct().withColumn("_in_manifest", F.lit(True))
    plan = (requested.join(landed, KEYS, "left")
                     .join(known, KEYS, "left"))
    is_landed = F.col("row_count").isNotNull()
    skipped = F.lit(False) if force else (F.coalesce("_in_manifest", F.lit(False)) & is_landed)
    return plan.select("pos", *KEYS, is_landed.alias("landed"), skipped.alias("skipped"),
                       "row_count", "size_bytes")


def ingest_totals(plan: DataFrame) -> DataFrame:
    """S6 totals: downloaded (= loaded now), skipped, rows and MB over the request."""
    return plan.agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(F.col("landed") & ~F.col("skipped")).alias("loaded"),
        F.count_if("skipped").alias("skipped"),
        F.count_if(~F.col("landed")).alias("missing"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.round(F.coalesce(F.sum("size_bytes"), F.lit(0)) / F.lit(1e6), 1).alias("total_mb"),
    )


def availability(requested: DataFrame, landed: DataFrame, fail_fast: bool = False) -> DataFrame:
    """B2: status per requested month: ``ok`` when landed, else ``missing``.

    With ``fail_fast`` a missing month raises instead (only the count of
    missing months reaches the driver)."""
    marked = landed.select(*KEYS, *[c for c in ("row_count",) if c in landed.columns],
                           F.lit(True).alias("_landed"))
    if "row_count" not in marked.columns:
        marked = marked.withColumn("row_count", F.lit(None).cast("long"))
    out = (requested.join(marked, KEYS, "left")
                    .select("pos", *KEYS,
                            F.when(F.col("_landed"), "ok").otherwise("missing").alias("status"),
                            "row_count"))
    if fail_fast:
        missing = out.filter(F.col("status") == "missing").count()
        if missing:
            raise FileNotFoundError(f"{missing} requested month(s) have no landed file")
    return out


def load_decisions(requested: DataFrame, units: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """What to do with each requested month, before any of its files is opened.

    ``decision`` is ``missing`` (not landed), ``known`` (recorded, and its files are
    as they were; a recording without fingerprint counts as such), ``changed``
    (landed anew since) or ``new``; ``load`` says whether to read it."""
    known = manifest.select(*KEYS, F.col("fingerprint").alias("_was"), F.col("row_count").alias("_rows"), F.lit(True).alias("_known"))
    plan = requested.join(units.select(*KEYS, "path", "size_bytes", "fingerprint"), KEYS, "left").join(known, KEYS, "left")
    decision = (F.when(F.col("path").isNull(), "missing").when(F.col("_known").isNull(), "new")
                .when(F.col("_was") != F.col("fingerprint"), "changed").otherwise("known"))
    return (plan.withColumn("decision", decision)
            .select("pos", *KEYS, "path", "size_bytes", "fingerprint", "decision",
                    F.col("decision").isin("new", "changed") | ((F.col("decision") == "known") & F.lit(force)),
                    F.when(F.col("decision") == "known", F.col("_rows")).alias("recorded_rows"))
            .toDF("pos", *KEYS, "path", "size_bytes", "fingerprint", "decision", "load", "recorded_rows"))


def ingest(spark: SparkSession, landing_root: str, manifest_path: str,
           requested: DataFrame, force: bool = False) -> DataFrame:
    """S4-S6 end to end: plan the requested months against the landing zone
    and the manifest, record the newly loaded months (append), return the plan.

    ``requested`` has (pos, taxi_type, month).  Months that are recorded and
    unchanged are left alone: their files are listed, never opened, and their row
    counts are the recorded ones.  A month with a file that cannot be read is
    planned without a row count and not recorded, so that it is tried again."""
    shared_root(spark)
    manifest = manifest_latest(read_manifest(spark, manifest_path))
    decisions = load_decisions(requested, landing_listing(spark, landing_root), manifest, force).checkpoint(eager=True)
    load = decisions.filter("load").select(F.col("path").alias("unit"))
    files = landed_files(spark, landing_root).select("unit", "path", "length").join(load, "unit", "left_semi")
    stats = unit_stats(spark, [], files).select("path", "row_count", "columns")
    full = decisions.join(stats, "path", "left").checkpoint(eager=True)
    new = (full.filter(F.col("load") & F.col("row_count").isNotNull())
               .select("month", "taxi_type", F.col("path").alias("file"), "size_bytes", "row_count",
                       "columns", F.localtimestamp().alias("ingested_at"), "fingerprint"))
    record(new, manifest_path)
    return full.select("pos", *KEYS, (F.col("decision") != "missing").alias("landed"),
                       ((F.col("decision") == "known") & ~F.col("load")).alias("skipped"),
                       F.coalesce("row_count", "recorded_rows").alias("row_count"), "size_bytes", "decision")


def audit_units(spark: SparkSession, schemas: dict[Unit, T.StructType]) -> dict[Unit, str]:
    """B2: the units whose rows cannot all be read, and why.

    One pass decodes every column of every unit with unreadable rows skipped, and
    holds the rows seen in each file against the count in its footer (files without
    a readable footer count as broken).  Only broken files reach the driver."""
    found: dict[str, str] = {}
    key, old = "spark.sql.files.ignoreCorruptFiles", spark.conf.get("spark.sql.files.ignoreCorruptFiles", "false")
    groups: dict[tuple, list[Unit]] = {}
    for u, schema in schemas.items():
        groups.setdefault(tuple((f.name, f.dataType) for f in schema.fields), []).append(u)
    shared_root(spark)
    for units in groups.values():
        files = _listed(spark, [u.path for u in units])
        spark.conf.set(key, "true")
        try:
            rows = spark.read.schema(schemas[units[0]]).parquet(*[u.path for u in units])
            decoded = F.bit_xor(F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in rows.columns]))
            seen = (rows.groupBy(F.col("_metadata.file_path").alias("url"))
                    .agg(F.count(F.lit(1)).alias("seen"), decoded.alias("_")).checkpoint(eager=True))
        finally:
            spark.conf.set(key, old)
        # the scan's paths are percent-encoded, the listing's are not
        name = F.regexp_replace(F.url_decode(F.replace("url", F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
        joined = (footers_anyhow(files).withColumn("name", F.regexp_replace("path", "^file:/+", "file:/"))
                  .join(seen.select(name.alias("name"), "seen"), "name", "left"))
        broken = joined.filter("error IS NOT NULL OR coalesce(seen, 0) <> row_count")
        for r in broken.collect():
            found[r.path] = r.error or f"{r.seen or 0} of {r.row_count} rows could be read"
    plain = {re.sub("^file:/+", "/", p): why for p, why in found.items()}
    out = {}
    for u in schemas:
        at = re.sub("^file:/+", "/", u.path).rstrip("/")
        why = next((w for p, w in plain.items() if p == at or p.startswith(at + "/")), None)
        if why:
            out[u] = why
    return out


# -- C32 per file: schema drift of every landed month --------------------------------

def file_schema_drift(spark: SparkSession, root: str, expected: T.StructType) -> DataFrame:
    """Missing / mistyped / extra columns of EVERY landed month.

    Names are compared exactly; a month that cannot be read is ``unreadable``.
    Spark reads the footers; only schemas (months x columns) reach the driver."""
    units = [Unit(r.path, r.taxi_type, r.month) for r in
             landing_listing(spark, root).select("path", "taxi_type", "month").collect()]
    exp = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = []
    for u, schema in unit_schemas(spark, units).items():
        if isinstance(schema, Exception):
            rows.append((*u, None, "unreadable", None, type(schema).__name__))
            continue
        actual = {f.name: f.dataType.simpleString() for f in schema.fields}
        rows += [(*u, n, "missing", t, None) for n, t in exp.items() if n not in actual]
        rows += [(*u, n, "wrong_type", exp[n], t) for n, t in actual.items() if n in exp and t != exp[n]]
        rows += [(*u, n, "extra", None, t) for n, t in actual.items() if n not in exp]
    return spark.createDataFrame(rows, "path string, taxi_type string, month string, column_name string, "
                                       "issue string, expected string, actual string")
