"""Versioned publishing (S8-S10) and stored accounting."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SF001, trip
from tripforge.operators import reports as RP
from tripforge.plans.accounting import month_accounting
from tripforge.plans.pipeline import publish_months, run_months, stored_totals
from tripforge.session import local_path
from tripforge.sources import sinks as S
from tripforge.sources import snapshots as V
from tripforge.sources.fixtures import trips

MONTHS = [("yellow", "2024-01"), ("yellow", "2024-02"), ("yellow", "2024-03")]


def totals(df):
    return {r.file_month: r.n for r in df.groupBy("file_month").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_nothing_published(spark, tmp_out):
    assert V.load(spark, tmp_out) == V.Snapshot() and V.versions(spark, tmp_out) == []
    with pytest.raises(FileNotFoundError):
        V.read(spark, tmp_out, "features")


def test_snapshots_agree_with_the_plain_run(spark, tmp_out):
    raw = trips(spark, SF001)
    plain = run_months(spark, raw, f"{tmp_out}/plain", MONTHS)
    _, snap = publish_months(spark, raw, f"{tmp_out}/versioned", MONTHS)
    for table, other in (("features", S.read_features(spark, plain.features_root)),
                         ("validated", S.read_valid(spark, plain.validated_root)),
                         ("quarantine", S.read_quarantine_table(spark, plain.quarantine_root))):
        got = V.read(spark, f"{tmp_out}/versioned", table, snap)
        assert sorted(got.columns) == sorted(other.columns), table
        other = other.select(*got.columns)
        assert got.count() == other.count() > 0 and got.exceptAll(other).count() == 0, table
    assert stored_totals(spark, f"{tmp_out}/versioned", versioned=True).collect() == stored_totals(spark, plain.out_root).collect()


def test_reader_sees_whole_snapshots_during_reruns(spark, tmp_out):
    raw = trips(spark, SF001)
    publish_months(spark, raw, tmp_out, MONTHS)
    whole = totals(V.read(spark, tmp_out, "features"))
    # the rerun drops half the rows of two months, and all rows of some days with them
    half = raw.filter("trip_id % 2 = 0")
    after = whole | {m: n for m, n in totals(V.read(spark, tmp_out, "features").filter("trip_id % 2 = 0")).items() if m != "2024-01"}
    assert after != whole
    stop, seen, failed = threading.Event(), [], []

    def reader():
        while not stop.is_set():
            try:
                seen.append(totals(V.read(spark, tmp_out, "features")))
            except Exception as e:  # noqa: BLE001 - any failure of a reader fails the test
                failed.append(e)
                return
    t = threading.Thread(target=reader)
    t.start()
    try:
        publish_months(spark, half, tmp_out, MONTHS[1:])
        while not failed and (not seen or seen[-1] != after) and len(seen) < 200:
            stop.wait(0.1)
    finally:
        stop.set()
        t.join()
    assert not failed
    assert all(s in (whole, after) for s in seen) and seen[0] == whole and seen[-1] == after
    # the older snapshot is still what it was
    assert totals(V.read(spark, tmp_out, "features", 1)) == whole


def test_commits_are_optimistic(spark, tmp_out):
    def entry(run, n=1):
        return {"run": run, "rows": dict.fromkeys(V.TABLES, n)}
    base = V.load(spark, tmp_out)
    a = V.commit(spark, tmp_out, base, {"yellow/2024-01": entry("a")}, {"a": {}})
    # another month from the same base: taken over, under the next number
    b = V.commit(spark, tmp_out, base, {"yellow/2024-02": entry("b")}, {"b": {}})
    assert (a.version, b.version) == (1, 2) and sorted(b.months) == ["yellow/2024-01", "yellow/2024-02"]
    # the same month from the old base, or one of two: nothing is published
    with pytest.raises(V.SnapshotConflict, match="2024-02"):
        V.commit(spark, tmp_out, a, {"yellow/2024-02": entry("c"), "yellow/2024-03": entry("c")}, {"c": {}})
    assert V.versions(spark, tmp_out) == [1, 2] and V.load(spark, tmp_out) == b
    c = V.commit(spark, tmp_out, b, {"yellow/2024-01": entry("c")}, {"c": {}})
    assert sorted(c.schemas) == ["b", "c"]                  # of runs that hold a month


def test_racing_writers_lose_no_month(spark, tmp_out):
    base, n = V.load(spark, tmp_out), 12

    def write(i):
        V.commit(spark, tmp_out, base, {f"yellow/20{10 + i}-01": {"run": f"r{i}", "rows": {}}}, {f"r{i}": {}})
    threads = [threading.Thread(target=write, args=(i,)) for i in range(n)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(V.load(spark, tmp_out).months) == n and V.versions(spark, tmp_out) == list(range(1, n + 1))


def test_names_are_taken_once(spark, tmp_out):
    path = f"{tmp_out}/{V.FOLDER}/v000000000001.json"
    assert V._create(spark, path, "{}") and not V._create(spark, path, "[]")
    folder = local_path(f"{tmp_out}/{V.FOLDER}")
    assert os.listdir(folder) == ["v000000000001.json"] and open(f"{folder}/v000000000001.json").read() == "{}"
    # the way of stores without hard links
    for name, text in (("one", "1"), ("two", "2")):
        open(f"{folder}/{name}", "w").write(text)
    assert V._rename_to_free(spark, f"{tmp_out}/{V.FOLDER}/one", f"{tmp_out}/{V.FOLDER}/free")
    assert not V._rename_to_free(spark, f"{tmp_out}/{V.FOLDER}/two", f"{tmp_out}/{V.FOLDER}/free")
    assert open(f"{folder}/free").read() == "1"


def test_conflicting_run_leaves_nothing(spark, tmp_out, make_trips, monkeypatch):
    df = make_trips(trip())
    publish_months(spark, df, tmp_out, [("yellow", "2024-01")])
    commit = V.commit

    def late(spark, root, base, months, schemas):
        commit(spark, root, base, {k: {"run": "other", "rows": dict.fromkeys(V.TABLES, 0)} for k in months}, {"other": next(iter(schemas.values()))})
        return commit(spark, root, base, months, schemas)
    monkeypatch.setattr(V, "commit", late)
    before = os.listdir(local_path(f"{tmp_out}/features"))
    with pytest.raises(V.SnapshotConflict):
        publish_months(spark, df, tmp_out, [("yellow", "2024-01")])
    assert os.listdir(local_path(f"{tmp_out}/features")) == before
    assert V.read(spark, tmp_out, "features").count() == 0       # the other run's


def test_months_without_rows_and_runs_of_differing_schemas(spark, tmp_out, make_trips):
    bad = make_trips(trip(trip_distance=-1.0), month="2024-02")
    publish_months(spark, make_trips(trip(), trip()), tmp_out, [("yellow", "2024-01")])
    publish_months(spark, bad.withColumn("note", F.lit("late")), tmp_out, [("yellow", "2024-02"), ("yellow", "2024-05")])
    feats, quarantine = V.read(spark, tmp_out, "features"), V.read(spark, tmp_out, "quarantine")
    assert totals(feats) == {"2024-01": 2} and "note" in feats.columns
    assert [r.note for r in quarantine.collect()] == ["late"] and totals(quarantine) == {"2024-02": 1}
    assert totals(V.read(spark, tmp_out, "validated")) == {"2024-01": 2}
    # a rerun that finds no rows empties its month
    publish_months(spark, make_trips(trip()).limit(0), tmp_out, [("yellow", "2024-01")])
    assert totals(V.read(spark, tmp_out, "features")) == {}


def test_expired_runs_are_removed(spark, tmp_out, make_trips):
    df = make_trips(trip(), trip(file_month="2024-02"))
    runs = [publish_months(spark, df, tmp_out, m)[0].run_id for m in
            ([("yellow", "2024-01"), ("yellow", "2024-02")], [("yellow", "2024-01")], [("yellow", "2024-01")])]
    # the first run still holds a month
    assert V.expire(spark, tmp_out, keep=1) == [runs[1]]
    assert V.versions(spark, tmp_out) == [3] and V.expire(spark, tmp_out, keep=1) == []
    assert sorted(os.listdir(local_path(f"{tmp_out}/features"))) == sorted(f"run={runs[i]}" for i in (0, 2))
    assert totals(V.read(spark, tmp_out, "features")) == {"2024-01": 1, "2024-02": 1}
    with pytest.raises(ValueError):
        V.expire(spark, tmp_out, keep=0)


def test_stored_totals_read_no_other_month(spark, tmp_out):
    raw = trips(spark, SF001)
    run_months(spark, raw, tmp_out, MONTHS[:2])
    root = local_path(f"{tmp_out}/accounting")

    def files(month):
        d = f"{root}/taxi_type=yellow/file_month={month}"
        return {f: os.stat(f"{d}/{f}").st_mtime_ns for f in os.listdir(d)}
    before = {m: files(m) for _, m in MONTHS[:2]}
    run_months(spark, raw, tmp_out, MONTHS[2:])
    assert {m: files(m) for _, m in MONTHS[:2]} == before
    want = RP.run_totals(month_accounting(raw)).collect()
    assert stored_totals(spark, tmp_out).collect() == want
    # only the stored counters are read
    read = [json.loads(json.dumps(f)) for f in stored_totals(spark, tmp_out).inputFiles()]
    assert read and all("/accounting/" in f for f in read)
    # a month that comes without rows the next time counts no more
    run_months(spark, raw.limit(0), tmp_out, MONTHS[2:])
    assert stored_totals(spark, tmp_out).first().months_processed == 2
