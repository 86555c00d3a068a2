"""Scanning monthly trip files.

Two landing layouts are supported.  Months of one schema are read by ONE scan,
however many they are; months whose files differ get a scan for each distinct
schema (``read_units``):

* Hive layout ``<root>/taxi_type=T/file_month=M/*.parquet`` (the Spark-native
  landing zone): month and type are partition columns - free per row, and a
  filter on them prunes whole directories at planning time.
* Flat monthly files ``{taxi_type}_tripdata_{YYYY-MM}.parquet`` (as published):
  month and type come from the hidden ``_metadata.file_name`` with two
  fixed-position string functions (a per-row regex costs more than all
  31 contract rules together).
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from typing import Iterable, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.functions.contract import RAW_TRIP_SCHEMA
from tripforge.functions.rules import ABSENT_COL

FILE_RE_MONTH = r"(\d{4}-\d{2})\.parquet$"
FILE_RE_TYPE = r"^([A-Za-z0-9]+)_tripdata_"
FILE_RE = re.compile(r"^([A-Za-z0-9]+)_tripdata_(\d{4}-\d{2})\.parquet$")
PARTITION_COLS = ("taxi_type", "file_month")


def trip_file_name(taxi_type: str, month: str) -> str:
    return f"{taxi_type}_tripdata_{month}.parquet"


def parse_file_name(name: str) -> tuple[str, str]:
    m = FILE_RE.match(name)
    if not m:
        raise ValueError(f"not a monthly trip file name: {name!r}")
    return m.group(1), m.group(2)


def normalise_nan(df: DataFrame) -> DataFrame:
    """H1: NaN -> NULL on every floating column (pandas treats both as missing,
    Spark orders NaN above every number)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


class Unit(NamedTuple):
    """A landed month: a file, a directory of part files or a Hive month directory."""

    path: str
    taxi_type: str
    month: str


def unit_schemas(spark: SparkSession, units: Iterable[Unit]) -> dict[Unit, T.StructType | Exception]:
    """Every unit's own schema from its footers, or what kept it from being read."""
    def schema(u: Unit):
        try:
            return spark.read.option("mergeSchema", "true").parquet(u.path).schema
        except Exception as e:  # noqa: BLE001 - the caller decides whether a month may be left out
            return e
    units = list(units)
    with ThreadPoolExecutor(max_workers=8) as pool:
        return dict(zip(units, pool.map(schema, units)))


def _unit_scan(spark: SparkSession, schema: T.StructType, units: list[Unit], hive: bool) -> DataFrame:
    """One scan of units of one schema and layout, with type and month from the paths."""
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    if hive:
        taxi_type, month = (F.substring_index(F.substring_index(path, f"/{c}=", -1), "/", 1) for c in PARTITION_COLS)
    else:
        # a monthly "file" written by Spark is a directory of part files: then
        # the monthly name is the parent directory
        parent = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
        seg = F.when(F.instr(name, "_tripdata_") > 0, name).otherwise(parent)
        # "<type>_tripdata_YYYY-MM.parquet": month = the 7 chars before ".parquet"
        taxi_type, month = F.substring_index(seg, "_tripdata_", 1), F.substring(seg, -15, 7)
    df = spark.read.schema(schema).parquet(*[u.path for u in units])
    return df.select("*", taxi_type.alias("taxi_type"), month.alias("file_month"))


def read_units(spark: SparkSession, schemas: dict[Unit, T.StructType]) -> DataFrame:
    """Raw trips of landed months whose schemas may differ.

    Units of equal schema share a scan.  Names that differ in case are one column
    (spelt as in the contract where it has it); numeric types are widened, other
    differing types become the contract's where a value can be read as such.  A
    column that only some months have is null in the others, whose rows name it in
    ``_absent_columns`` so that no rule holds its absence against them."""
    groups: dict[tuple, list[Unit]] = {}
    for u, schema in schemas.items():
        hive = "/file_month=" in u.path
        groups.setdefault((hive, tuple((f.name, f.dataType) for f in schema.fields)), []).append(u)
    spelling = {f.name.lower(): f for f in RAW_TRIP_SCHEMA.fields}
    types: dict[str, set] = {}
    for _, fields in groups:
        for n, t in fields:
            types.setdefault(n.lower(), set()).add(t)
    frames = []
    for (hive, fields), units in groups.items():
        df = _unit_scan(spark, schemas[units[0]], units, hive)
        if len(groups) > 1:
            cols = []
            for n, _ in fields:
                c, want = F.col("`" + n.replace("`", "``") + "`"), spelling.get(n.lower())
                if len(types[n.lower()]) > 1 and not all(isinstance(t, T.NumericType) for t in types[n.lower()]):
                    c = c.try_cast(want.dataType if want else T.StringType())
                cols.append(c.alias(want.name if want else n))
            here = {n.lower() for n, _ in fields}
            absent = sorted(spelling[n].name if n in spelling else n for n in types if n not in here)
            if any(len(f) < len(types) for _, f in groups):
                cols.append(F.lit("".join(f",{n}," for n in absent)).alias(ABSENT_COL))
            df = df.select(*cols, *PARTITION_COLS)
        frames.append(df)
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return normalise_nan(out.select(*[c for c in out.columns if c not in PARTITION_COLS], *PARTITION_COLS))


def read_trips(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Raw trips of flat monthly files, with ``taxi_type`` and ``file_month``.

    File names are validated on the driver (they are the listing, not data);
    a missing file raises like the reference's missing-input error."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    schemas = unit_schemas(spark, [Unit(p, *parse_file_name(p.rstrip("/").rsplit("/", 1)[-1])) for p in paths])
    for s in schemas.values():
        if isinstance(s, Exception):
            raise s
    return read_units(spark, schemas)


def read_landed(spark: SparkSession, root: str, *, merge_schema: bool = False) -> DataFrame:
    """Raw trips of a Hive-layout landing zone (``taxi_type=/file_month=``)."""
    reader = spark.read.option("mergeSchema", "true") if merge_schema else spark.read
    df = reader.parquet(root)
    for c in PARTITION_COLS:  # H12: partition values stay text
        df = df.withColumn(c, F.col(c).cast("string"))
    return normalise_nan(df)


def land(raw: DataFrame, root: str) -> None:
    """Write raw trips (with taxi_type, file_month) into the Hive landing
    layout, replacing only the months present in ``raw``."""
    (raw.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLS).parquet(root))
