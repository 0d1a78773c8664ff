import datetime as dt
import json

import pytest
from conftest import line

from barkeep.plans.backfill import FAILED, SUCCEEDED, backfill
from barkeep.functions.ranges import DayRange
from barkeep.sources.raw_files import monthly_ranges, read_ranges, write_ranges


def work_list(spark, path, items):
    file = path / "ranges.json"
    keys = ("input_path", "start_date", "end_date")
    file.write_text(json.dumps({"months": [dict(zip(keys, i)) for i in items]}, indent=2))
    return read_ranges(spark, str(file))


def loaded(spark, table):
    return sorted((r.ticker, str(r.trade_date), r.open) for r in spark.table(table).collect())


def test_work_list_keeps_order(spark, tmp_path):
    ranges = work_list(
        spark, tmp_path, [("/b/", "2024-02-01", "2024-02-29"), ("/a/", "2024-01-01", "2024-01-31")]
    )
    assert [tuple(r) for r in ranges.orderBy("range_id").collect()] == [
        (0, "/b/", dt.date(2024, 2, 1), dt.date(2024, 2, 29)),
        (1, "/a/", dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
    ]


@pytest.mark.parametrize("mode", ["permissive", "strict"])
def test_one_missing_range_does_not_stop_the_rest(spark, raw_zone, table_name, mode):
    raw_zone("2024-01-02", [line("aa", "2024-01-02")])
    raw_zone("2024-02-01", [line("aa", "2024-02-01"), line("bb", "2024-03-05")])
    root = raw_zone.root
    ranges = work_list(
        spark,
        raw_zone.path,
        [
            (f"{root}/year=2024/month=01/", "2024-01-01", "2024-01-31"),
            (f"{root}/year=2023/month=12/", "2023-12-01", "2023-12-31"),
            (f"{root}/year=2024/month=02/", "2024-02-01", "2024-02-29"),
        ],
    )
    done = backfill(spark, ranges, table_name, mode).orderBy("range_id").collect()
    assert [(r.status, r.files, r.bars) for r in done] == [
        (SUCCEEDED, 1, 1),
        (FAILED, 0, 0),
        (SUCCEEDED, 1, 1),
    ]
    assert loaded(spark, table_name) == [("AA", "2024-01-02", 1.0), ("AA", "2024-02-01", 1.0)]


def test_strict_mode_fails_only_the_range_with_unreadable_cells(spark, raw_zone, table_name):
    raw_zone("2024-01-02", [line("aa", "2024-01-02"), line("bb", "2024-01-02", price="x")])
    raw_zone("2024-02-01", [line("aa", "2024-02-01")])
    raw_zone("2024-03-01", ["cc,1,1,1,1,1,soon,1"])
    root = raw_zone.root
    items = [(root, f"2024-0{m}-01", f"2024-0{m}-28") for m in (1, 2, 3)]
    ranges = work_list(spark, raw_zone.path, items)
    done = backfill(spark, ranges, table_name, "strict").orderBy("range_id").collect()
    assert [(r.status, r.unreadable) for r in done] == [(FAILED, 1), (SUCCEEDED, 0), (FAILED, 1)]
    assert loaded(spark, table_name) == [("AA", "2024-02-01", 1.0)]


def test_later_range_decides_a_shared_day(spark, raw_zone, table_name):
    raw_zone("2024-01-02", [line("aa", "2024-01-02"), line("bb", "2024-01-02")], root="one")
    raw_zone("2024-01-02", [line("aa", "2024-01-02", price="7.0")], root="two")
    raw_zone("2024-01-03", [line("aa", "2024-01-03")], root="one")
    base = raw_zone.path
    items = [(str(base / r), "2024-01-01", "2024-01-31") for r in ("one", "two")]
    backfill(spark, work_list(spark, base, items), table_name)
    assert loaded(spark, table_name) == [("AA", "2024-01-02", 7.0), ("AA", "2024-01-03", 1.0)]


def test_monthly_work_list(spark, tmp_path):
    months = monthly_ranges(spark, "s3://zone/bars/", DayRange.of("2024-01-01", "2026-04-24"))
    write_ranges(months, str(tmp_path / "list"))
    rows = read_ranges(spark, str(tmp_path / "list")).orderBy("range_id").collect()
    assert len(rows) == 28
    assert tuple(rows[1]) == (
        1, "s3://zone/bars/year=2024/month=02/", dt.date(2024, 2, 1), dt.date(2024, 2, 29)
    )
    assert (rows[-1].start_date, rows[-1].end_date) == (dt.date(2026, 4, 1), dt.date(2026, 4, 24))
