"""Against a database embedded in the Spark driver's own process (local mode)."""

import uuid

import pytest
from conftest import line

from barkeep.functions.ranges import DayRange
from barkeep.plans.load import load_relational
from barkeep.sinks.relational import (
    ensure_target,
    read_relational,
    upsert_relational,
    upsert_statements,
    widen_statement,
)
from barkeep.sources.raw_files import NoDataError


@pytest.fixture
def database(spark):
    system = spark.sparkContext._jvm.java.lang.System
    system.setProperty("derby.stream.error.file", "/dev/null")
    return f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"


def test_load_update_and_count(spark, raw_zone, database):
    target = (database, "market", "daily")
    raw_zone("2024-01-02", [line("a", "2024-01-02"), line("A", "2024-01-02", price="2.0", offset=5)])
    raw_zone("2024-01-03", [line("A", "2024-01-03"), line("", "2024-01-03")])
    done = load_relational(spark, raw_zone.root, *target, days=DayRange.of("2024-01-01", "2024-01-03"))
    assert (done.file_days, done.rows_staged, done.rows_upserted) == (2, 4, 2)
    first = read_relational(spark, *target)
    assert sorted((str(r.trade_date), r.open) for r in first.collect()) == [
        ("2024-01-02", 2.0), ("2024-01-03", 1.0),
    ]
    stamps = {r.trade_date: r.loaded_at for r in first.collect()}

    raw_zone("2024-01-03", [line("A", "2024-01-03", price="7.0"), line("B", "2024-01-03")])
    done = load_relational(spark, raw_zone.root, *target, days=DayRange.of("2024-01-03"), batch_rows=1)
    assert done.rows_upserted == 2
    rows = read_relational(spark, *target).collect()
    assert sorted((r.ticker, str(r.trade_date), r.open) for r in rows) == [
        ("A", "2024-01-02", 2.0), ("A", "2024-01-03", 7.0), ("B", "2024-01-03", 1.0),
    ]
    for r in rows:
        if r.ticker == "A":
            assert (r.loaded_at > stamps[r.trade_date]) == (str(r.trade_date) == "2024-01-03")
    # The stage tables are gone.
    tables = spark.read.format("jdbc").option("url", database).option(
        "query", "SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T'"
    ).load()
    assert [r[0] for r in tables.collect()] == ["daily"]


def test_missing_days(spark, raw_zone, database):
    raw_zone("2024-01-02", [line("A", "2024-01-02")])
    target = (database, "market", "daily")
    none = DayRange.of("2023-01-01")
    assert load_relational(spark, raw_zone.root, *target, days=none).rows_upserted == 0
    assert load_relational(spark, raw_zone.root + "-absent", *target).rows_upserted == 0
    for path in (raw_zone.root, raw_zone.root + "-absent"):
        with pytest.raises(NoDataError):
            load_relational(spark, path, *target, days=none, require_data=True)


def test_ensure_target_twice_and_statements(spark, database):
    for _ in range(2):
        ensure_target(spark, database, "market", "daily")
    columns = read_relational(spark, database, "market", "daily").columns
    assert columns[0] == "ticker" and columns[-1] == "loaded_at"
    assert widen_statement("market", "daily") == (
        'ALTER TABLE "market"."daily" ALTER COLUMN "volume" SET DATA TYPE DOUBLE PRECISION'
    )
    assert "DISTINCT" in upsert_statements("market", "daily", "stage", "clean")[0]


def test_rows_staged_twice_by_a_rerun_task_count_once(spark, raw_zone, database):
    from barkeep.plans.load import bars_from_text
    from barkeep.sources.raw_files import scan_text

    raw_zone("2024-01-02", [line("A", "2024-01-02"), line("B", "2024-01-02")])
    ensure_target(spark, database, "market", "daily")
    rows = bars_from_text(scan_text(spark, raw_zone.root))
    assert upsert_relational(rows.union(rows), database, "market", "daily") == 2
