import os

import pytest
from conftest import line

from barkeep.sinks.versions import compact, create_versioned_table, current_rows
from barkeep.streaming.keyed import STATE_SETTINGS, STATE_STORE, LateBarsError, ingest_keyed


@pytest.fixture
def ingest(spark, raw_zone, table_name, tmp_path):
    create_versioned_table(spark, table_name, str(tmp_path / "versions"), buckets=4)

    def run(**options):
        os.makedirs(raw_zone.root, exist_ok=True)
        ingest_keyed(spark, raw_zone.root, table_name, str(tmp_path / "checkpoint"), **options)
        rows = current_rows(spark, table_name).collect()
        return sorted((r.ticker, str(r.trade_date), r.open) for r in rows)

    return run


def test_last_file_day_wins_over_restarts_and_compactions(spark, raw_zone, ingest, table_name):
    raw_zone("2024-01-05", [line("A", "2024-01-02", price="5.0"), line("B", "2024-01-05")])
    first = [("A", "2024-01-02", 5.0), ("B", "2024-01-05", 1.0)]
    assert ingest() == first
    assert ingest() == first
    # An older file day comes later: its bar of A gives way.
    raw_zone("2024-01-02", [line("a", "2024-01-02", price="2.0"), line("C", "2024-01-02")])
    assert ingest() == [*first, ("C", "2024-01-02", 1.0)]
    compact(spark, table_name)
    raw_zone("2024-01-08", [line("A", "2024-01-02", price="8.0"), ",1,1,1,1,1,1,1"])
    assert ingest(files_per_batch=1) == [("A", "2024-01-02", 8.0), first[1], ("C", "2024-01-02", 1.0)]


def test_a_batch_that_failed_is_done_again(raw_zone, ingest, monkeypatch):
    from barkeep.streaming import keyed

    raw_zone("2024-01-02", [line("A", "2024-01-02")])
    add = keyed.upsert_version

    def breaks_after(*args, **kwargs):
        add(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(keyed, "upsert_version", breaks_after)
    with pytest.raises(Exception, match="lost"):
        ingest()
    monkeypatch.undo()
    assert ingest() == [("A", "2024-01-02", 1.0)]


def test_bars_too_late_are_not_left_out_in_silence(raw_zone, ingest):
    raw_zone("2024-06-03", [line("A", "2024-06-03")])
    assert ingest(late_days=30) == [("A", "2024-06-03", 1.0)]
    raw_zone("2024-06-04", [line("A", "2024-05-20"), line("A", "2024-01-02")])
    with pytest.raises(LateBarsError):
        ingest(late_days=30)
    assert ingest(late_days=30) == [("A", "2024-05-20", 1.0), ("A", "2024-06-03", 1.0)]


def _state_files(tmp_path, ending):
    return list((tmp_path / "checkpoint" / "state").rglob(f"*.{ending}"))


def test_state_is_kept_on_disk_not_in_the_heap(spark, raw_zone, ingest, tmp_path):
    raw_zone("2024-01-05", [line("A", "2024-01-02", price="5.0")])
    ingest()
    raw_zone("2024-01-02", [line("A", "2024-01-02", price="2.0"), line("B", "2024-01-02")])
    assert ingest() == [("A", "2024-01-02", 5.0), ("B", "2024-01-02", 1.0)]
    assert _state_files(tmp_path, "sst") and not _state_files(tmp_path, "delta")
    assert all(spark.conf.get(key, "") == "" for key in STATE_SETTINGS)


def test_a_checkpoint_goes_on_with_the_store_it_was_begun_with(spark, raw_zone, ingest, tmp_path):
    key = f"{STATE_STORE}.providerClass"
    in_heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    raw_zone("2024-01-05", [line("A", "2024-01-02", price="5.0")])
    spark.conf.set(key, in_heap)
    try:
        ingest()
        assert spark.conf.get(key) == in_heap
    finally:
        spark.conf.unset(key)
    raw_zone("2024-01-02", [line("A", "2024-01-02", price="2.0"), line("B", "2024-01-02")])
    assert ingest() == [("A", "2024-01-02", 5.0), ("B", "2024-01-02", 1.0)]
    assert _state_files(tmp_path, "delta") and not _state_files(tmp_path, "sst")
