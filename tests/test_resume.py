import datetime as dt
import os

import pytest
from conftest import line

from barkeep.plans import backfill as module
from barkeep.plans.backfill import FAILED, SUCCEEDED, resumable_backfill


@pytest.fixture
def zone(spark, raw_zone, table_name):
    def run(months, at_once=1, mode="permissive"):
        items = [
            (i, f"{raw_zone.root}/year=2024/month=0{m}", dt.date(2024, m, 1), dt.date(2024, m, 28))
            for i, m in enumerate(months)
        ]
        listed = spark.createDataFrame(items, "range_id int, input_path string, start_date date, end_date date")
        done = resumable_backfill(spark, listed, table_name, f"{table_name}_done", mode, at_once=at_once)
        return [(r.status, r.bars, r.resumed) for r in done.orderBy("range_id").collect()]

    run.rows = lambda: sorted((r.ticker, str(r.trade_date), r.open) for r in spark.table(table_name).collect())
    for m in (1, 2, 3):
        raw_zone(f"2024-0{m}-02", [line("a", f"2024-0{m}-02")])
    return run


ALL = [("A", f"2024-0{m}-02", 1.0) for m in (1, 2, 3)]


def test_a_backfill_killed_between_two_ranges_is_resumed(zone, monkeypatch):
    write, calls = module.write_table, []

    def dies(*args):
        calls.append(args)
        if len(calls) == 2:
            raise KeyboardInterrupt
        write(*args)

    monkeypatch.setattr(module, "write_table", dies)
    with pytest.raises(KeyboardInterrupt):
        zone([1, 2, 3])
    monkeypatch.undo()
    assert zone.rows() == ALL[:1]
    assert zone([1, 2, 3]) == [(SUCCEEDED, 1, True), (SUCCEEDED, 1, False), (SUCCEEDED, 1, False)]
    assert zone.rows() == ALL
    assert zone([1, 2, 3]) == [(SUCCEEDED, 1, True)] * 3


def test_replaced_new_and_missing_files_are_loaded_again(zone, raw_zone):
    assert [r[0] for r in zone([1, 2, 4], at_once=2)] == [SUCCEEDED, SUCCEEDED, FAILED]
    file = raw_zone("2024-02-02", [line("a", "2024-02-02", price="7.0")])
    os.utime(file, (1, 1))
    raw_zone("2024-04-02", [line("a", "2024-04-02")])
    assert [r[2] for r in zone([1, 2, 4], at_once=5)] == [True, False, False]
    assert zone.rows() == [ALL[0], ("A", "2024-02-02", 7.0), ("A", "2024-04-02", 1.0)]
    # Another mode reads rows differently.
    assert [r[2] for r in zone([1], mode="strict")] == [False]


def test_later_ranges_that_share_a_day_follow_an_earlier_one(spark, raw_zone, table_name):
    def run():
        items = [(i, str(raw_zone.path / r), dt.date(2024, 1, 1), dt.date(2024, 1, 31)) for i, r in enumerate(("one", "two"))]
        listed = spark.createDataFrame(items, "range_id int, input_path string, start_date date, end_date date")
        done = resumable_backfill(spark, listed, table_name, f"{table_name}_done", at_once=1).orderBy("range_id").collect()
        return [r.resumed for r in done], [r.open for r in spark.table(table_name).collect()]

    first = raw_zone("2024-01-02", [line("a", "2024-01-02")], root="one")
    raw_zone("2024-01-02", [line("a", "2024-01-02", price="7.0")], root="two")
    assert run() == ([False, False], [7.0])
    assert run() == ([True, True], [7.0])
    os.utime(first, (1, 1))
    assert run() == ([False, False], [7.0])
