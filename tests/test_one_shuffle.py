"""Loads bring rows together once, and stage only what they compare."""

import datetime as dt
import os
import re

from conftest import line
from pyspark.sql import functions as F

from barkeep.operators.dedup import latest_per_key
from barkeep.operators.extremes import new_day_extremes, range_extremes
from barkeep.plans import backfill as plan
from barkeep.plans.quarantine import BROKEN, checked_rows, load_checked
from barkeep.schema import BAR_COLUMNS, METRIC_COLUMNS
from barkeep.scratch import scratch_root
from barkeep.sinks.tables import create_bars_table, write_latest
from barkeep.sinks.upsert import upsert_table
from barkeep.sources import raw_files
from barkeep.sources.raw_files import large_days, scan_text
from barkeep.streaming.ingest import ingest_new_files
from workload.inputs import raw_bars


def bars_of(spark, days=3, tickers=40, copies=2):
    rows = [
        (f"T{t}", dt.date(2024, 1, 1 + d), 10 * d + c, 1.0 * t, 1.0, 1.0, 2.0, 0.5, c)
        for d in range(days) for t in range(tickers) for c in range(copies)
    ]
    types = "string, date, long, double, double, double, double, double, long".split(", ")
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(BAR_COLUMNS, types)))


def staged(spark, label):
    root = scratch_root(spark)
    return {f for f in os.listdir(root) if f.startswith(f"{label}-")} if os.path.isdir(root) else set()


def rows_of(df):
    return sorted(map(tuple, df.select(*BAR_COLUMNS).collect()))


def test_dedup_by_day_has_one_shuffle(spark, table_name):
    df = latest_per_key(bars_of(spark), cluster_by=("trade_date",))
    plan_text = df._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("Exchange") == 1 and "hashpartitioning(trade_date" in plan_text
    create_bars_table(spark, table_name)
    write_latest(bars_of(spark), table_name)
    assert rows_of(spark.table(table_name)) == rows_of(latest_per_key(bars_of(spark)))


def test_large_days_are_loaded_in_parts(spark, raw_zone, table_name, monkeypatch):
    raw_zone("2024-01-02", [line(f"T{i}", "2024-01-02") for i in range(60)])
    raw_zone("2024-01-03", [line("A", "2024-01-03")])
    monkeypatch.setattr(raw_files, "DAY_BYTES", 200)
    parts = large_days(spark, raw_zone.root)
    assert list(parts) == [dt.date(2024, 1, 2)] and parts[dt.date(2024, 1, 2)] > 1
    create_bars_table(spark, table_name)
    write_latest(bars_of(spark), table_name, parts=parts)
    assert rows_of(spark.table(table_name)) == rows_of(latest_per_key(bars_of(spark)))
    files = spark.table(table_name).selectExpr("trade_date", "_metadata.file_path f").distinct()
    counts = {r.trade_date.day: r["count"] for r in files.groupBy("trade_date").count().collect()}
    assert counts[2] > 1 and counts[1] == counts[3] == 1


def test_day_files_are_shuffled_as_line_items(spark):
    text = raw_bars(spark, "/root/testdata/sf0.001", by_day=True)._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("l_suppkey") < text.index("RebalancePartitions")
    assert "Project" in text[: text.index("RebalancePartitions")]


def test_a_stream_of_new_days_stages_a_batch_once(spark, raw_zone, table_name, tmp_path):
    before = staged(spark, "stream-batch"), staged(spark, "upsert")
    raw_zone("2024-01-02", [line("A", "2024-01-02"), line("B", "2024-01-02")])
    ingest_new_files(spark, raw_zone.root, table_name, str(tmp_path / "checkpoint"))
    raw_zone("2024-01-03", [line("A", "2024-01-03")])
    ingest_new_files(spark, raw_zone.root, table_name, str(tmp_path / "checkpoint"))
    assert len(staged(spark, "stream-batch") - before[0]) == 2 and staged(spark, "upsert") == before[1]
    # A later file restates a bar, an earlier one does not.
    raw_zone("2024-01-05", [line("A", "2024-01-02", volume="7")])
    ingest_new_files(spark, raw_zone.root, table_name, str(tmp_path / "checkpoint"))
    raw_zone("2024-01-01", [line("A", "2024-01-02", volume="8")])
    ingest_new_files(spark, raw_zone.root, table_name, str(tmp_path / "checkpoint"))
    found = {(r.ticker, r.trade_date.day): r.volume for r in spark.table(table_name).collect()}
    assert found == {("A", 2): 7.0, ("B", 2): 100.0, ("A", 3): 100.0}
    assert spark.table(f"{table_name}__file_days").count() == 3


def test_rows_that_are_loaded_are_not_staged_as_json(spark, raw_zone, table_name):
    raw_zone("2024-01-02", [line("A", "2024-01-02"), line("B", "2024-01-02", volume="n/a")])
    raw = scan_text(spark, raw_zone.root, with_path=True, broken=BROKEN)
    assert {r.ticker: r.row is None for r in checked_rows(raw).collect()} == {"A": True, "B": False}
    before = staged(spark, "aside")
    done = load_checked(spark, raw_zone.root, table_name, f"{table_name}_aside")
    assert (done.rows_read, done.rows_aside) == (2, 1) and staged(spark, "aside") == before
    load_checked(spark, raw_zone.root, table_name, f"{table_name}_aside")
    assert spark.table(f"{table_name}_aside").count() == 1


def test_a_first_upsert_of_unique_rows_is_not_staged(spark, table_name):
    create_bars_table(spark, table_name)
    before = staged(spark, "upsert")
    rows = latest_per_key(bars_of(spark))
    upsert_table(table_name, rows, already_unique=True)
    assert staged(spark, "upsert") == before
    upsert_table(table_name, rows.filter("ticker = 'T1'").withColumn("volume", rows.volume + 1), already_unique=True)
    found = spark.table(table_name)
    assert found.count() == 120 and found.filter("ticker = 'T1' and volume = 2").count() == 3


def test_the_file_at_fault_is_set_apart_at_once(spark, raw_zone, table_name, monkeypatch):
    for month in range(1, 9):
        bad = month == 6
        header = "ticker,volume,open,close,low,window_start,transactions" if bad else None
        day = f"2024-{month:02d}-05"
        raw_zone(day, [line("A", day)], **({"header": header} if bad else {}))
    calls = []
    read = plan._read
    monkeypatch.setattr(plan, "_read", lambda spark, items, *a: calls.append(len(items)) or read(spark, items, *a))
    listed = [
        (i, f"{raw_zone.root}/year=2024/month={i:02d}", dt.date(2024, i, 1), dt.date(2024, i, 28)) for i in range(1, 9)
    ]
    ranges = spark.createDataFrame(listed, "range_id int, input_path string, start_date date, end_date date")
    done = {r.range_id: r.status for r in plan.backfill(spark, ranges, table_name).collect()}
    assert [i for i, status in done.items() if status == plan.FAILED] == [6]
    assert sorted(calls) == [1, 7, 8] and spark.table(table_name).count() == 7


def test_days_around_the_range_are_shuffled_without_what_is_not_read(spark):
    monthly = F.date_add(F.lit(dt.date(2024, 1, 1)), 28 * F.day("trade_date"))
    bars = latest_per_key(bars_of(spark, days=20, tickers=2)).withColumn("trade_date", monthly)
    first, last = dt.date(2025, 1, 1), dt.date(2025, 2, 28)
    got = range_extremes(bars, first, last, unique_days=True)
    for df in (got, new_day_extremes(bars, first, last)):
        plan_text = df._jdf.queryExecution().optimizedPlan().toString()
        below = plan_text[plan_text.index("Window [max(") :]
        for column in BAR_COLUMNS:
            read = column in ("ticker", "trade_date", "high", "low")
            assert bool(re.search(rf"CASE WHEN [^\n]* THEN {column}#", below)) != read
    # The range's own rows keep every column, and equal those of the plan for repeated days.
    by_row = lambda df: sorted(map(tuple, df.select(*METRIC_COLUMNS).collect()))
    assert by_row(got) == by_row(range_extremes(bars, first, last)) and got.count() == 4
    assert rows_of(got) == rows_of(bars.filter(bars.trade_date.between(first, last)))
