import datetime as dt
import math

import pytest
from conftest import DAY_NANOS, HEADER, line, nanos
from pyspark.errors import PySparkException

from barkeep.functions.ranges import DayRange
from barkeep.operators.dedup import latest_per_key
from barkeep.operators.normalize import STRICT, normalize_text, normalize_typed
from barkeep.plans.load import bars_from_raw, bars_from_text, load_bars
from barkeep.schema import BAR_COLUMNS
from barkeep.sinks.tables import write_table
from barkeep.sources.raw_files import (
    MissingColumnsError,
    list_files,
    read_csv,
    read_inferred,
    scan_bars,
    scan_text,
)


def by_ticker(df):
    return {r.ticker: r for r in df.collect()}


GOLDEN = [
    f"aapl,1000,1.0,2.0,3.0,0.5,{nanos('2024-01-02', 18_000_000_000_000)},10",
    line("MSFT", "2024-01-02", volume="1234.5"),
    line("", "2024-01-02"),
    "NOTS,5,1,1,1,1,,1",
    line("NANT", "2024-01-02", high="NaN"),
    f"LAST,1,1,1,1,1,{1704239999999999999},1",
    " pad ,1,1,1,1,1," + str(nanos("2024-01-02")) + ",1",
    '"",1,1,1,1,1,' + str(nanos("2024-01-02")) + ",1",
]


@pytest.mark.parametrize("text", [False, True])
def test_golden_rows(spark, raw_zone, text):
    file = raw_zone("2024-01-02", GOLDEN)
    if text:
        bars = bars_from_text(scan_text(spark, file))
    else:
        bars = bars_from_raw(scan_bars(spark, file))
    assert tuple(bars.columns) == BAR_COLUMNS
    rows = by_ticker(bars)
    assert sorted(rows) == [" PAD ", "AAPL", "LAST", "MSFT", "NANT"]
    assert rows["AAPL"].trade_date == dt.date(2024, 1, 2)
    assert (rows["AAPL"].open, rows["AAPL"].close, rows["AAPL"].high) == (1.0, 2.0, 3.0)
    assert rows["MSFT"].volume == 1234.5
    # The last nanosecond of a day stays in that day.
    assert rows["LAST"].trade_date == dt.date(2024, 1, 2)
    assert math.isnan(rows["NANT"].high)


def test_trade_date_ignores_the_session_zone(spark):
    raw = spark.createDataFrame(
        [("a", 1.0, 1.0, 1.0, 1.0, 1.0, n, 1) for n in (0, DAY_NANOS - 1, DAY_NANOS, -DAY_NANOS)],
        HEADER.replace("ticker", "ticker string")
        .replace("window_start", "window_start bigint")
        .replace("transactions", "transactions bigint")
        .replace("volume", "volume double")
        .replace("open", "open double")
        .replace("close", "close double")
        .replace("high", "high double")
        .replace("low", "low double"),
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        days = [str(r.trade_date) for r in normalize_typed(raw).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert days == ["1970-01-01", "1970-01-01", "1970-01-02", "1969-12-31"]


def test_unreadable_cells(spark, raw_zone):
    file = raw_zone(
        "2024-01-02", [line("BAD", "2024-01-02", price="xx"), line("OK", "2024-01-02")]
    )
    assert by_ticker(bars_from_raw(scan_bars(spark, file)))["BAD"].open is None
    lenient = by_ticker(bars_from_text(scan_text(spark, file), "permissive"))
    assert lenient["BAD"].open is None and lenient["OK"].open == 1.0
    with pytest.raises(PySparkException, match="column open: cannot read 'xx'"):
        bars_from_text(scan_text(spark, file), STRICT).collect()
    with pytest.raises(ValueError, match="unknown parse mode"):
        normalize_text(scan_text(spark, file), "careless")


def test_strict_refuses_a_fraction_in_an_integer_column(spark, raw_zone):
    file = raw_zone("2024-01-02", [line("A", "2024-01-02", transactions="12.0")])
    with pytest.raises(PySparkException, match="column transactions"):
        bars_from_text(scan_text(spark, file)).collect()


def test_newest_row_of_a_file_wins_and_case_variants_merge(spark, raw_zone):
    file = raw_zone(
        "2024-01-02",
        [
            line("aapl", "2024-01-02", price="1.0", offset=5),
            line("AAPL", "2024-01-02", price="2.0", offset=9),
            line("Aapl", "2024-01-02", price="3.0", offset=7),
        ],
    )
    for bars in (
        bars_from_raw(scan_bars(spark, file)),
        bars_from_text(scan_text(spark, file)),
    ):
        assert [(r.ticker, r.open) for r in bars.collect()] == [("AAPL", 2.0)]


def test_last_file_wins_even_with_an_older_window_start(spark, raw_zone):
    raw_zone("2024-01-02", [line("A", "2024-01-02", price="1.0", offset=9)])
    raw_zone("2024-01-03", [line("A", "2024-01-02", price="2.0", offset=1)])
    bars = bars_from_raw(scan_bars(spark, raw_zone.root))
    assert [r.open for r in bars.collect()] == [2.0]


def test_dedup_does_not_depend_on_order_or_partitioning(spark, raw_zone):
    lines = [line(f"T{i % 7}", "2024-01-02", price=f"{i}.0", offset=i % 3) for i in range(60)]
    file = raw_zone("2024-01-02", lines)
    rows = normalize_typed(scan_bars(spark, file))
    expected = sorted(map(tuple, latest_per_key(rows).collect()))
    shuffled = rows.repartition(9, "open").sortWithinPartitions("low", "open")
    assert sorted(map(tuple, latest_per_key(shuffled).collect())) == expected


def test_dedup_limits_before_the_shuffle(spark):
    plan = latest_per_key(
        spark.createDataFrame(
            [("A", dt.date(2024, 1, 2), 1)],
            "ticker string, trade_date date, window_start long",
        )
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_typed_scan_refuses_another_column_order(spark, raw_zone):
    swapped = "volume,ticker,open,close,high,low,window_start,transactions"
    file = raw_zone("2024-01-02", ["5,A,1,1,1,1,1,1"], header=swapped)
    with pytest.raises(Exception, match="CSV header"):
        scan_bars(spark, file).collect()


def test_text_scan_binds_every_file_by_its_own_header(spark, raw_zone):
    swapped = "volume,extra,ticker,open,close,high,low,window_start,transactions"
    raw_zone("2024-01-02", [line("A", "2024-01-02", volume="5")])
    raw_zone("2024-01-03", [f"7,x,B,1,1,1,1,{nanos('2024-01-03')},1"], header=swapped)
    bars = by_ticker(bars_from_text(scan_text(spark, raw_zone.root)))
    assert (bars["A"].volume, bars["B"].volume) == (5.0, 7.0)
    with pytest.raises(Exception, match="CSV header"):
        scan_text(spark, raw_zone.root, one_header=True).collect()


def test_text_scan_names_missing_columns(spark, raw_zone):
    raw_zone("2024-01-02", [line("A", "2024-01-02")])
    short = "ticker,volume,open,close,low,window_start,transactions"
    raw_zone("2024-01-03", ["A,1,1,1,1,1,1"], header=short)
    with pytest.raises(MissingColumnsError, match="2024-01-03.*high"):
        scan_text(spark, raw_zone.root)
    # Files outside the requested days are not judged.
    assert scan_text(spark, raw_zone.root, DayRange.of("2024-01-02")).count() == 1


def test_text_scan_of_an_empty_file(spark, raw_zone):
    raw_zone("2024-01-02", [], header=None)
    with pytest.raises(MissingColumnsError):
        scan_text(spark, raw_zone.root)


def test_short_and_long_rows(spark, raw_zone):
    n = nanos("2024-01-02")
    file = raw_zone("2024-01-02", [f"A,1,1,1,1,1,{n}", f"B,1,1,1,1,1,{n},4,extra"])
    rows = by_ticker(bars_from_text(scan_text(spark, file)))
    assert rows["A"].transactions is None and rows["B"].transactions == 4


def test_scan_opens_only_the_files_of_the_days(spark, raw_zone):
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-09", "2024-02-01"):
        raw_zone(day, [line("A", day)])
    day = DayRange.of("2024-01-02")
    assert scan_bars(spark, raw_zone.root, day, slack_days=0).count() == 1
    assert scan_bars(spark, raw_zone.root, day, slack_days=1).count() == 3
    scan = scan_bars(spark, raw_zone.root, day, slack_days=1)
    scan.collect()
    metrics = scan._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics()
    assert metrics.apply("numFiles").value() == 3
    assert [str(r.trade_date) for r in list_files(spark, raw_zone.root, day).collect()] == ["2024-01-02"]


def test_inferred_scan(spark, raw_zone):
    file = raw_zone("2024-01-02", [line("A", "2024-01-02")])
    types = dict(read_inferred(spark, file).dtypes)
    assert (types["ticker"], types["open"], types["window_start"]) == ("string", "double", "bigint")
    assert read_csv(spark, file).dtypes[1] == ("volume", "string")


def test_load_leaves_other_days_alone_and_can_be_repeated(spark, raw_zone, table_name):
    for day in ("2024-01-02", "2024-01-03", "2024-01-04"):
        raw_zone(day, [line("A", day), line("B", day)])
    load_bars(spark, raw_zone.root, table_name)
    raw_zone("2024-01-03", [line("A", "2024-01-03", price="9.0")])
    for _ in range(2):
        load_bars(spark, raw_zone.root, table_name, "2024-01-03", "2024-01-03")
        rows = sorted((str(r.trade_date), r.ticker, r.open) for r in spark.table(table_name).collect())
        assert rows == [
            ("2024-01-02", "A", 1.0),
            ("2024-01-02", "B", 1.0),
            ("2024-01-03", "A", 9.0),
            ("2024-01-04", "A", 1.0),
            ("2024-01-04", "B", 1.0),
        ]


def test_append_and_unknown_disposition(spark, raw_zone, table_name):
    raw_zone("2024-01-02", [line("A", "2024-01-02")])
    for _ in range(2):
        load_bars(spark, raw_zone.root, table_name, disposition="append")
    assert spark.table(table_name).count() == 2
    with pytest.raises(ValueError, match="unknown write disposition"):
        load_bars(spark, raw_zone.root, table_name, disposition="replace")


def test_writing_no_rows_replaces_nothing(spark, raw_zone, table_name):
    raw_zone("2024-01-02", [line("A", "2024-01-02")])
    load_bars(spark, raw_zone.root, table_name)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    write_table(spark.table(table_name).filter("ticker = 'none'"), table_name)
    assert spark.table(table_name).count() == 1
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_malformed_bound_fails_before_a_job_runs(spark, raw_zone):
    file = raw_zone("2024-01-02", [line("A", "2024-01-02")])
    with pytest.raises(ValueError):
        bars_from_raw(scan_bars(spark, file), start="2024-13-01")


def test_files_not_named_by_a_day_are_read_whatever_the_bounds(spark, raw_zone):
    import os

    file = raw_zone("2024-01-02", [line("A", "2024-01-02"), line("A", "2024-01-03")])
    plain = os.path.join(os.path.dirname(file), "export.csv.gz")
    os.rename(file, plain)
    raw = scan_bars(spark, raw_zone.root, DayRange.of("2024-01-02"))
    assert bars_from_raw(raw, "2024-01-02", "2024-01-02").count() == 1


def test_a_day_split_over_several_files(spark, raw_zone):
    raw_zone("2024-01-02", [line("A", "2024-01-02")])
    raw_zone("2024-01-02-1", [line("B", "2024-01-02")])
    day = DayRange.of("2024-01-02")
    assert scan_bars(spark, raw_zone.root, day).count() == 2
    assert {r.file_day for r in scan_text(spark, raw_zone.root, day).collect()} == {day.start}


def test_one_sided_bounds(spark, raw_zone, table_name):
    for day in ("2024-01-02", "2024-01-05", "2024-01-08"):
        raw_zone(day, [line("A", day)])

    def loaded(name, **bounds):
        load_bars(spark, raw_zone.root, name, **bounds)
        return sorted(str(r.trade_date) for r in spark.table(name).collect())

    assert loaded(f"{table_name}_a", start="2024-01-05") == ["2024-01-05", "2024-01-08"]
    assert loaded(f"{table_name}_b", end="2024-01-05") == ["2024-01-02", "2024-01-05"]
