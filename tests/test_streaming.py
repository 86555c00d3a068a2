"""Incremental load: only new months are processed on the next trigger."""

from conftest import trip
from tripforge.sources import sinks as S
from tripforge.sources.trips import land
from tripforge.streaming.incremental import incremental_load


def test_incremental_only_new_months(spark, make_trips, tmp_out):
    landing, out, ckpt = f"{tmp_out}/landing", f"{tmp_out}/out", f"{tmp_out}/ckpt"
    land(make_trips(trip(), trip(VendorID=99), month="2024-01")
         .unionByName(make_trips(trip(), month="2024-02")), landing)
    first = incremental_load(spark, landing, out, ckpt)
    assert sorted(m for b in first for _, m in b) == ["2024-01", "2024-02"]
    assert S.read_valid(spark, f"{out}/validated").count() == 2

    second = incremental_load(spark, landing, out, ckpt)      # nothing new
    assert second == []

    land(make_trips(trip(), trip(), trip(), month="2024-03"), landing)
    third = incremental_load(spark, landing, out, ckpt)
    assert [m for b in third for _, m in b] == ["2024-03"]
    got = {r.file_month: r["count"] for r in
           S.read_valid(spark, f"{out}/validated").groupBy("file_month").count().collect()}
    assert got == {"2024-01": 1, "2024-02": 1, "2024-03": 3}


def test_default_checkpoint_survives_runs(spark, make_trips, tmp_out):
    landing, out = f"{tmp_out}/landing", f"{tmp_out}/out"
    land(make_trips(trip(), month="2024-01"), landing)
    assert [m for b in incremental_load(spark, landing, out) for _, m in b] == ["2024-01"]
    assert incremental_load(spark, landing, out) == []          # same default checkpoint


def test_month_split_across_batches_is_rebuilt_whole(spark, make_trips, tmp_out):
    landing, out = f"{tmp_out}/landing", f"{tmp_out}/out"
    rows = make_trips(*[trip() for _ in range(6)], trip(VendorID=99), month="2024-01").repartition(3)
    land(rows, landing)                                     # several files for one month
    batches = incremental_load(spark, landing, out, max_files_per_trigger=1)
    assert len(batches) >= 2 and all(b == [("yellow", "2024-01")] for b in batches)
    assert S.read_valid(spark, f"{out}/validated").count() == 6        # never a partial month
    q = S.read_quarantine_table(spark, f"{out}/quarantine")
    assert q.count() == 1


def test_incremental_records_manifest(spark, make_trips, tmp_out):
    from tripforge.sources import landing as L
    landing, out, man = f"{tmp_out}/landing", f"{tmp_out}/out", f"{tmp_out}/manifest"
    land(make_trips(trip(), trip(VendorID=99), month="2024-01"), landing)
    incremental_load(spark, landing, out, manifest_path=man)
    land(make_trips(trip(), month="2024-02"), landing)
    incremental_load(spark, landing, out, manifest_path=man)
    latest = {r.month: (r.row_count, r.size_bytes > 0, "VendorID" in r.columns)
              for r in L.manifest_latest(L.read_manifest(spark, man)).collect()}
    assert latest == {"2024-01": (2, True, True), "2024-02": (1, True, True)}
    assert L.read_manifest(spark, man).count() == 2          # nothing recorded twice
