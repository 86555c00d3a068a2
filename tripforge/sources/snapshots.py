"""Versioned publishing of months: readers see whole runs only.

  features/run=R/taxi_type=T/file_month=M/pickup_date=D/   (as validated/, quarantine/, accounting/)
  _snapshots/v000000000007.json                            for each month the run that holds it

A versioned run writes directories of its own, which nothing refers to until
its months are committed: a new numbered snapshot that names, for every
published month, the run that holds it.  Snapshots are created whole under a
name that must be free (a hard link on a POSIX file system, a rename that never
overwrites elsewhere) and never altered, so a reader, who resolves one snapshot
and reads the directories it names, cannot meet a mix of old and new days.

Commits are optimistic: a writer that finds the head moved takes the other
writers' months over and tries the next number; when one of its own months was
published by someone else meanwhile it gives up with ``SnapshotConflict``.
Rewritten directories stay for readers of older snapshots until ``expire``.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import dataclass, field
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripforge.session import local_path
from tripforge.sources import sinks as S

FOLDER = "_snapshots"
NAME = re.compile(r"^v(\d{12})\.json$")
# what a month's entry counts rows of -> the directories below a run's that hold them
TABLES = {"validated": f"validated/run={{run}}/{S.STATUS_COL}={S.VALID}", "quarantine": "quarantine/run={run}",
          "features": "features/run={run}", "accounting": "accounting/run={run}"}


class SnapshotConflict(RuntimeError):
    """Another writer published one of the months since this run began."""


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    months: Mapping[str, dict] = field(default_factory=dict)      # "T/M" -> {"run": R, "rows": {table: n}}
    schemas: Mapping[str, dict] = field(default_factory=dict)     # R -> {table: schema}


def month_key(taxi_type: str, month: str) -> str:
    return f"{taxi_type}/{month}"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _rename_to_free(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename unless ``dst`` exists (atomic where the store's rename is)."""
    from py4j.protocol import Py4JJavaError
    jvm, p, _ = _hadoop(spark, src)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(p, jvm.org.apache.hadoop.fs.Path(dst), spark.sparkContext._gateway.new_array(rename, 0))
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """A new file with all of ``text``, or False where the name is taken."""
    parent, name = path.rsplit("/", 1)
    draft = f"{parent}/.{name}-{uuid.uuid4().hex}"
    local = local_path(path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local_path(draft), "x", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(local_path(draft), local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(local_path(draft))
    S.write_text(spark, draft, text, overwrite=False)
    done = _rename_to_free(spark, draft, path)
    if not done:
        S._fs_delete(spark, draft)
    return done


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the snapshots that exist, oldest first."""
    _, p, fs = _hadoop(spark, f"{root}/{FOLDER}")
    if not fs.exists(p):
        return []
    found = (NAME.match(st.getPath().getName()) for st in fs.listStatus(p))
    return sorted(int(m[1]) for m in found if m)


def _path(root: str, version: int) -> str:
    return f"{root}/{FOLDER}/v{version:012d}.json"


def load(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """A snapshot, by default the newest; the empty one (version 0) before the first commit."""
    if version is None:
        version = max(versions(spark, root), default=0)
    if version == 0:
        return Snapshot()
    d = json.loads(S.read_text(spark, _path(root, version)))
    return Snapshot(d["version"], d["months"], d["schemas"])


def commit(spark: SparkSession, root: str, base: Snapshot, months: Mapping[str, dict], schemas: Mapping[str, dict]) -> Snapshot:
    """Publish ``months`` of a run that began at ``base``; all of them or none."""
    while True:
        head = load(spark, root)
        taken = sorted(k for k in months if head.months.get(k) != base.months.get(k))
        if taken:
            raise SnapshotConflict(f"published by another run since version {base.version}: {', '.join(taken)}")
        now = {**head.months, **months}
        runs = {e["run"] for e in now.values()}
        new = Snapshot(head.version + 1, now, {r: s for r, s in {**head.schemas, **schemas}.items() if r in runs})
        if _create(spark, _path(root, new.version), json.dumps(new.__dict__, sort_keys=True)):
            return new


def read(spark: SparkSession, root: str, table: str, snapshot: Snapshot | int | None = None) -> DataFrame:
    """``validated`` (valid rows), ``quarantine``, ``features`` or ``accounting``
    as one snapshot has it; months whose run found no such rows add none.

    Runs of one schema are one scan; columns that a run did not have are null."""
    snap = snapshot if isinstance(snapshot, Snapshot) else load(spark, root, snapshot)
    if not snap.months:
        raise FileNotFoundError(f"nothing is published under {root}")
    paths: dict[str, list[str]] = {}
    for key, entry in sorted(snap.months.items()):
        taxi_type, month = key.split("/")
        held = paths.setdefault(json.dumps(snap.schemas[entry["run"]][table], sort_keys=True), [])
        if entry["rows"][table]:
            held.append(f"{root}/{TABLES[table].format(run=entry['run'])}/taxi_type={taxi_type}/file_month={month}")
    out = None
    for text, held in paths.items():
        schema = T.StructType.fromJson(json.loads(text))
        if held:
            # the run and, of valid rows, the status are directories only
            df = spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*held).select(*schema.names)
        else:
            df = spark.createDataFrame([], schema)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.drop(*(c for c in (S.STATUS_COL, S.RUN_COL, S.OUTLIER_COL) if c in out.columns),
                    *([S.REASONS_COL] if table == "validated" else []))


def discard(spark: SparkSession, root: str, run: str) -> None:
    """Remove what a run wrote that no snapshot names."""
    for table in TABLES:
        S._fs_delete(spark, f"{root}/{table}/run={run}")


def expire(spark: SparkSession, root: str, keep: int = 10) -> list[str]:
    """Drop all but the newest ``keep`` snapshots, and the runs that only those
    named; returns these runs.  Runs that are under way are not touched.

    A run that still holds one published month is kept whole."""
    if keep < 1:
        raise ValueError("the newest snapshot is always kept")
    all_versions = versions(spark, root)
    old, new = all_versions[:-keep], all_versions[-keep:]
    runs = [{e["run"] for v in vs for e in load(spark, root, v).months.values()} for vs in (old, new)]
    # pointers first: from then on nobody finds the runs
    for v in old:
        S._fs_delete(spark, _path(root, v))
    gone = sorted(runs[0] - runs[1])
    for run in gone:
        discard(spark, root, run)
    return gone
