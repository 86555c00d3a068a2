"""Listings, manifest, month ranges."""

import pytest
from pyspark.sql import functions as F

from tripforge.sources import landing as L


def months(df):
    return [r.month for r in df.orderBy("pos").collect()]


def test_month_range_inclusive_and_crosses_year(spark):
    assert months(L.month_range(spark, "2023-11", "2024-02")) == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert months(L.month_range(spark, "2024-01", "2024-01")) == ["2024-01"]


def test_month_range_reversed_is_error(spark):
    with pytest.raises(ValueError):
        L.month_range(spark, "2024-03", "2024-01")


def test_month_range_bad_format(spark):
    with pytest.raises(ValueError):
        L.month_range(spark, "2024-1", "2024-02")


def _manifest(spark, rows):
    df = spark.createDataFrame(
        [(m, t, None, None, n, None, ts) for m, t, n, ts in rows],
        "month string, taxi_type string, file string, size_bytes bigint, row_count bigint, "
        "columns array<string>, ingested_at string")
    return df.withColumn("ingested_at", F.to_timestamp_ntz("ingested_at"))


def test_manifest_last_recording_wins(spark):
    m = _manifest(spark, [("2024-01", "yellow", 1, "2024-02-01 00:00:00"),
                          ("2024-01", "yellow", 2, "2024-02-02 00:00:00"),
                          ("2024-02", "yellow", 5, "2024-03-01 00:00:00")])
    got = {(r.month, r.row_count) for r in L.manifest_latest(m).collect()}
    assert got == {("2024-01", 2), ("2024-02", 5)}


def test_manifest_persist_append_and_reload(spark, tmp_out):
    path = f"{tmp_out}/manifest"
    assert L.read_manifest(spark, path).count() == 0                      # empty load
    L.record(_manifest(spark, [("2024-01", "yellow", 1, "2024-02-01 00:00:00")]), path)
    L.record(_manifest(spark, [("2024-01", "yellow", 7, "2024-02-05 00:00:00"),
                               ("2024-02", "yellow", 3, "2024-03-01 00:00:00")]), path)
    latest = {(r.month, r.row_count) for r in L.manifest_latest(L.read_manifest(spark, path)).collect()}
    assert latest == {("2024-01", 7), ("2024-02", 3)}
    keys = spark.createDataFrame([("yellow", "2024-01"), ("yellow", "2024-05")], "taxi_type string, month string")
    assert [r.month for r in L.manifest_contains(L.read_manifest(spark, path), keys).collect()] == ["2024-01"]


def test_pending_and_force(spark):
    landed = spark.createDataFrame([("yellow", "2024-01", 10, 1_250_000), ("yellow", "2024-02", 20, 2_330_000)],
                                   "taxi_type string, month string, row_count bigint, size_bytes bigint")
    m = _manifest(spark, [("2024-01", "yellow", 10, "2024-02-01 00:00:00")])
    assert [r.month for r in L.pending(landed, m).collect()] == ["2024-02"]
    assert L.pending(landed, m, force=True).count() == 2
    req = L.month_range(spark, "2023-12", "2024-02").withColumn("taxi_type", F.lit("yellow"))
    plan = L.ingest_plan(req, landed, m).orderBy("pos").collect()
    assert [(r.month, r.landed, r.skipped) for r in plan] == [
        ("2023-12", False, False), ("2024-01", True, True), ("2024-02", True, False)]
    t = L.ingest_totals(L.ingest_plan(req, landed, m)).collect()[0]
    assert (t.requested, t.loaded, t.skipped, t.missing, t.total_rows) == (3, 1, 1, 1, 30)
    assert t.total_mb == 3.6


def test_availability_and_fail_fast(spark):
    landed = spark.createDataFrame([("yellow", "2024-01", 10)], "taxi_type string, month string, row_count bigint")
    req = L.month_range(spark, "2023-12", "2024-01").withColumn("taxi_type", F.lit("yellow"))
    got = [(r.month, r.status) for r in L.availability(req, landed).orderBy("pos").collect()]
    assert got == [("2023-12", "missing"), ("2024-01", "ok")]
    with pytest.raises(FileNotFoundError):
        L.availability(req, landed, fail_fast=True)


def test_landing_listing_and_file_stats(spark, make_trips, tmp_out):
    from conftest import trip
    root = f"{tmp_out}/raw"
    df = make_trips(trip(), trip()).drop("taxi_type", "file_month")
    df.coalesce(1).write.parquet(f"{root}/yellow_tripdata_2024-01.parquet")
    listing = L.landing_listing(spark, root).collect()
    assert {(r.taxi_type, r.month) for r in listing} == {("yellow", "2024-01")}
    stats = L.file_stats(spark, [f"{root}/yellow_tripdata_2024-01.parquet"]).collect()
    assert sum(r.row_count for r in stats) == 2 and stats[0].size_bytes > 0
    assert "VendorID" in stats[0].columns


def test_ingest_records_only_new_months(spark, make_trips, tmp_out):
    from conftest import trip
    root, man = f"{tmp_out}/raw", f"{tmp_out}/manifest"
    make_trips(trip(), trip()).drop("taxi_type", "file_month").write.parquet(f"{root}/yellow_tripdata_2024-01.parquet")
    make_trips(trip()).drop("taxi_type", "file_month").write.parquet(f"{root}/yellow_tripdata_2024-02.parquet")
    req = L.month_range(spark, "2023-12", "2024-02").withColumn("taxi_type", F.lit("yellow"))
    plan1 = {r.month: (r.landed, r.skipped, r.row_count) for r in L.ingest(spark, root, man, req).collect()}
    assert plan1 == {"2023-12": (False, False, None), "2024-01": (True, False, 2), "2024-02": (True, False, 1)}
    m = L.read_manifest(spark, man)
    assert m.count() == 2 and "VendorID" in m.collect()[0].columns
    plan2 = {r.month: r.skipped for r in L.ingest(spark, root, man, req).collect()}
    assert plan2 == {"2023-12": False, "2024-01": True, "2024-02": True}
    assert L.read_manifest(spark, man).count() == 2                     # nothing re-recorded
    L.ingest(spark, root, man, req, force=True).collect()
    assert L.read_manifest(spark, man).count() == 4                     # force re-records
    assert L.manifest_latest(L.read_manifest(spark, man)).count() == 2


def test_flat_single_files(spark, make_trips, tmp_out):
    """Published layout: one plain parquet file per month (not a directory)."""
    import glob
    import shutil
    from conftest import trip
    from tripforge.session import local_path
    from tripforge.sources.trips import read_trips
    stage, root = f"{tmp_out}/stage", local_path(f"{tmp_out}/flat")
    make_trips(trip(), trip(VendorID=99)).drop("taxi_type", "file_month").coalesce(1).write.parquet(stage)
    part = glob.glob(local_path(stage) + "/part-*.parquet")[0]
    import os
    os.makedirs(root)
    shutil.copy(part, f"{root}/green_tripdata_2023-11.parquet")
    shutil.copy(part, f"{root}/yellow_tripdata_2024-05.parquet")
    units = {(r.taxi_type, r.month): r.size_bytes for r in L.landing_listing(spark, root).collect()}
    assert set(units) == {("green", "2023-11"), ("yellow", "2024-05")} and all(units.values())
    raw = read_trips(spark, [f"{root}/green_tripdata_2023-11.parquet", f"{root}/yellow_tripdata_2024-05.parquet"])
    got = {(r.taxi_type, r.file_month): r["count"] for r in raw.groupBy("taxi_type", "file_month").count().collect()}
    assert got == {("green", "2023-11"): 2, ("yellow", "2024-05"): 2}
    stats = {r.path.rsplit("/", 1)[-1]: r.row_count for r in L.unit_stats(spark, [f"{root}"]).collect()}
    assert stats == {"green_tripdata_2023-11.parquet": 2, "yellow_tripdata_2024-05.parquet": 2}


def test_file_schema_drift_per_file(spark, make_trips, tmp_out):
    from conftest import trip
    from pyspark.sql import functions as F
    from tripforge.functions.contract import RAW_TRIP_SCHEMA
    root = f"{tmp_out}/drift"
    base = make_trips(trip()).drop("taxi_type", "file_month")
    base.drop("trip_id").write.parquet(f"{root}/yellow_tripdata_2024-01.parquet")             # clean
    base.drop("trip_id", "Airport_fee").write.parquet(f"{root}/yellow_tripdata_2024-02.parquet")  # missing
    base.drop("trip_id").withColumn("VendorID", F.col("VendorID").cast("long")) \
        .write.parquet(f"{root}/yellow_tripdata_2024-03.parquet")                              # wrong type
    got = {(r.month, r.column_name, r.issue) for r in
           L.file_schema_drift(spark, root, RAW_TRIP_SCHEMA).collect()}
    assert got == {("2024-02", "Airport_fee", "missing"), ("2024-03", "VendorID", "wrong_type")}


def test_file_schema_drift_hive_layout(spark, make_trips, tmp_out):
    from conftest import trip
    from tripforge.functions.contract import RAW_TRIP_SCHEMA
    from tripforge.sources.trips import land
    land(make_trips(trip(), month="2024-04"), f"{tmp_out}/hive")
    got = {(r.month, r.column_name, r.issue) for r in
           L.file_schema_drift(spark, f"{tmp_out}/hive", RAW_TRIP_SCHEMA).collect()}
    assert got == {("2024-04", "trip_id", "extra")}          # partition columns live in the path


def test_cli_ingest_and_profile(spark, make_trips, tmp_out, capsys):
    from conftest import trip
    from tripforge.__main__ import main
    root, man = f"{tmp_out}/raw", f"{tmp_out}/manifest"
    make_trips(trip(), trip()).drop("taxi_type", "file_month").write.parquet(f"{root}/yellow_tripdata_2024-01.parquet")
    assert main(["ingest", "--landing", root, "--manifest", man, "--start", "2024-01", "--end", "2024-02"]) == 0
    assert L.read_manifest(spark, man).count() == 1
    assert main(["profile", "--input", "/root/testdata/sf0.001/orders.parquet", "--out", f"{tmp_out}/prof"]) == 0
    prof = spark.read.json(f"{tmp_out}/prof")
    assert prof.count() == 6 and "p50" in prof.columns


def test_ingest_on_hive_landing(spark, make_trips, tmp_out):
    from conftest import trip
    from tripforge.sources.trips import land
    root, man = f"{tmp_out}/hive", f"{tmp_out}/manifest"
    land(make_trips(trip(), trip(), month="2024-01").unionByName(make_trips(trip(), month="2024-02")), root)
    units = {(r.taxi_type, r.month): r.path.rsplit("/", 2)[-2:] for r in L.landing_listing(spark, root).collect()}
    assert units == {("yellow", "2024-01"): ["taxi_type=yellow", "file_month=2024-01"],
                     ("yellow", "2024-02"): ["taxi_type=yellow", "file_month=2024-02"]}
    req = L.month_range(spark, "2024-01", "2024-03").withColumn("taxi_type", F.lit("yellow"))
    plan = {r.month: (r.landed, r.row_count) for r in L.ingest(spark, root, man, req).collect()}
    assert plan == {"2024-01": (True, 2), "2024-02": (True, 1), "2024-03": (False, None)}


def _months_landed(make_trips, root, rows):
    from conftest import trip
    for m, n in rows.items():
        make_trips(*[trip() for _ in range(n)]).drop("taxi_type", "file_month").coalesce(1) \
            .write.mode("overwrite").parquet(f"{root}/yellow_tripdata_{m}.parquet")


def test_known_months_are_never_opened(spark, make_trips, tmp_out, monkeypatch):
    """Footers are read for new and changed months only; re-landed months are found."""
    root, man = f"{tmp_out}/raw", f"{tmp_out}/manifest"
    req = L.month_range(spark, "2024-01", "2024-04").withColumn("taxi_type", F.lit("yellow"))
    opened, real = [], L.footers

    def counted(files):
        opened.extend(r.path.rsplit("/", 2)[-2][-15:-8] for r in files.select("path").collect())
        return real(files)
    monkeypatch.setattr(L, "footers", counted)

    def run():
        opened.clear()
        plan = {r.month: (r.decision, r.skipped, r.row_count) for r in L.ingest(spark, root, man, req).collect()}
        return plan, sorted(opened)
    _months_landed(make_trips, root, {"2024-01": 2, "2024-02": 3})
    assert run() == ({"2024-01": ("new", False, 2), "2024-02": ("new", False, 3), "2024-03": ("missing", False, None),
                      "2024-04": ("missing", False, None)}, ["2024-01", "2024-02"])
    assert run()[1] == []                                               # nothing new: nothing opened
    _months_landed(make_trips, root, {"2024-02": 5, "2024-03": 0})      # landed anew, and an empty month
    plan, seen = run()
    assert seen == ["2024-02", "2024-03"]
    assert plan == {"2024-01": ("known", True, 2), "2024-02": ("changed", False, 5), "2024-03": ("new", False, 0),
                    "2024-04": ("missing", False, None)}
    latest = {r.month: r.row_count for r in L.manifest_latest(L.read_manifest(spark, man)).collect()}
    assert latest == {"2024-01": 2, "2024-02": 5, "2024-03": 0}
    t = L.ingest_totals(L.ingest(spark, root, man, req)).collect()[0]
    assert (t.loaded, t.skipped, t.missing, t.total_rows) == (0, 3, 1, 7)   # the empty month is landed
    sizes = {r.month: r.size_bytes for r in L.ingest(spark, root, man, req).collect()}
    assert all(sizes[m] > 0 for m in ("2024-01", "2024-02", "2024-03")) and sizes["2024-04"] is None


def test_recordings_without_fingerprint_stay_known(spark, make_trips, tmp_out):
    root, man = f"{tmp_out}/raw", f"{tmp_out}/manifest"
    _months_landed(make_trips, root, {"2024-01": 2})
    L.record(_manifest(spark, [("2024-01", "yellow", 9, "2024-02-01 00:00:00")]), man)
    req = L.month_range(spark, "2024-01", "2024-01").withColumn("taxi_type", F.lit("yellow"))
    r = L.ingest(spark, root, man, req).collect()[0]
    assert (r.decision, r.skipped, r.row_count) == ("known", True, 9)


def test_each_file_has_its_own_columns(spark, tmp_out):
    """Files that differ, an empty one, one that is no parquet, and odd names."""
    from tripforge.session import local_path
    spark.range(3).withColumn("b", F.lit(1)).coalesce(1).write.parquet(f"{tmp_out}/s/a one#1.parquet")
    spark.range(2).select(F.lit("x").alias("z"), "id").coalesce(1).write.parquet(f"{tmp_out}/s/b.parquet")
    spark.range(0).withColumn("c", F.lit(1.5)).coalesce(1).write.parquet(f"{tmp_out}/s/c.parquet")
    with open(f"{local_path(tmp_out)}/s/bad.parquet", "wb") as f:
        f.write(b"no parquet at all")
    rows = L.file_stats(spark, [f"{tmp_out}/s"]).collect()
    got = sorted((r.row_count, r.columns) for r in rows if r.error is None)
    assert got == [(0, ["id", "c"]), (2, ["z", "id"]), (3, ["id", "b"])]
    assert [(r.file_name, r.row_count) for r in rows if r.error] == [("bad.parquet", None)]
    assert all(r.size_bytes > 0 for r in rows)


def test_an_unreadable_month_is_not_recorded(spark, make_trips, tmp_out):
    import os
    from tripforge.session import local_path
    root, man = f"{tmp_out}/raw", f"{tmp_out}/manifest"
    _months_landed(make_trips, root, {"2024-01": 2})
    os.makedirs(f"{local_path(root)}/yellow_tripdata_2024-02.parquet")
    with open(f"{local_path(root)}/yellow_tripdata_2024-02.parquet/part-0.parquet", "wb") as f:
        f.write(b"broken")
    req = L.month_range(spark, "2024-01", "2024-02").withColumn("taxi_type", F.lit("yellow"))
    plan = {r.month: (r.landed, r.skipped, r.row_count) for r in L.ingest(spark, root, man, req).collect()}
    assert plan == {"2024-01": (True, False, 2), "2024-02": (True, False, None)}
    assert [r.month for r in L.read_manifest(spark, man).collect()] == ["2024-01"]


def test_recordings_of_one_instant_have_one_outcome(spark, tmp_out):
    at = "2024-02-01 00:00:00"
    rows = [_manifest(spark, [("2024-01", "yellow", n, at)]) for n in (5, 9, 2)]
    for order in ((0, 1, 2), (2, 1, 0), (1, 0, 2)):
        path = f"{tmp_out}/{''.join(map(str, order))}"
        for i in order:
            L.record(rows[i], path)
        m = L.read_manifest(spark, path)
        # the last writer's, who saw the others' recordings
        assert L.manifest_latest(m).first().row_count == (5, 9, 2)[order[-1]]
        assert sorted(r.seq for r in m.collect()) == [1, 2, 3]
    # writers that did not see one another: the same one from either order of files
    same = [r.withColumn("seq", F.lit(1)) for r in rows]
    assert {L.manifest_latest(a.unionByName(b)).first().row_count for a, b in ((same[0], same[1]), (same[1], same[0]))} == {9}


def test_compaction_loses_no_recording(spark, tmp_out, monkeypatch):
    def entry(i, n=1):
        return _manifest(spark, [(f"20{10 + i}-01", "yellow", n, f"2024-02-{n:02d} 00:00:00")])
    assert L.compact_manifest(spark, tmp_out) == 0               # nothing there
    for i in range(3):
        L.record(entry(i), tmp_out)
    L.record(entry(0, 7), tmp_out)
    before = L.read_manifest(spark, tmp_out)
    append = L._append

    def late(df, path):
        # another writer records while the compaction is under way
        append(df, path)
        if not done:
            done.append(1)
            L.record(entry(9), path)
    done = []
    monkeypatch.setattr(L, "_append", late)
    assert L.compact_manifest(spark, tmp_out) == 4
    monkeypatch.undo()
    assert before.count() == 4                                   # a reader that began before finds its files
    want = {("2010-01", 7), ("2011-01", 1), ("2012-01", 1), ("2019-01", 1)}
    def state():
        return {(r.month, r.row_count) for r in L.manifest_latest(L.read_manifest(spark, tmp_out)).collect()}
    assert state() == want
    # the next one deletes what the first folded, and folds the rest
    assert L.compact_manifest(spark, tmp_out) == 2 and state() == want
    assert L.compact_manifest(spark, tmp_out) == 0 and state() == want
    assert L.read_manifest(spark, tmp_out).count() == 4 == len(want)


def test_writers_side_by_side(spark, tmp_out):
    import threading
    threads = [threading.Thread(target=L.record, args=(_manifest(spark, [(f"20{10 + i}-01", "yellow", i, "2024-02-01 00:00:00")]), tmp_out))
               for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert L.read_manifest(spark, tmp_out).count() == 6
