import datetime as dt
import random

import pytest

from barkeep.operators.extremes import range_extremes
from barkeep.operators.merge import DuplicateKeyError
from barkeep.schema import BARS
from barkeep.sinks.versions import (
    compact,
    create_current_view,
    create_versioned_table,
    current_rows,
    upsert_version,
)


def bar(ticker, day, price):
    return (ticker, dt.date.fromisoformat(day), 1, 1.0, price, price, price, price, 1)


@pytest.fixture
def versioned(spark, tmp_path, table_name):
    create_versioned_table(spark, table_name, str(tmp_path / "versions"), buckets=4)
    return table_name


def upsert(spark, table, rows):
    return upsert_version(table, spark.createDataFrame(rows, BARS))


def prices(rows):
    return sorted((r.ticker, str(r.trade_date), r.open) for r in rows.collect())


def test_newest_version_of_a_key_counts(spark, versioned):
    assert upsert(spark, versioned, [bar("A", "2023-12-31", 1.0), bar("B", "2024-01-02", 1.0)]) == 1
    assert upsert(spark, versioned, [bar("B", "2024-01-02", 2.0), bar("C", "2024-01-02", 2.0)]) == 2
    assert upsert(spark, versioned, []) is None
    want = [("A", "2023-12-31", 1.0), ("B", "2024-01-02", 2.0), ("C", "2024-01-02", 2.0)]
    assert prices(current_rows(spark, versioned)) == want
    create_current_view(spark, f"{versioned}_now", versioned)
    assert prices(spark.table(f"{versioned}_now")) == want
    assert prices(current_rows(spark, versioned, "2024-01-01")) == want[1:]
    assert prices(current_rows(spark, versioned, None, "2023-12-31")) == want[:1]


def test_repeated_keys_are_refused_before_the_table_changes(spark, versioned):
    with pytest.raises(DuplicateKeyError):
        upsert(spark, versioned, [bar("A", "2024-01-02", 1.0), bar("A", "2024-01-02", 2.0)])
    assert prices(current_rows(spark, versioned)) == []


def test_random_upserts_and_compactions_equal_a_dictionary(spark, versioned):
    pick, model = random.Random(7), {}
    for step in range(6):
        keys = {(pick.choice("ABCDE"), f"202{pick.randint(2, 4)}-03-0{pick.randint(1, 9)}") for _ in range(12)}
        rows = [(ticker, day, float(step)) for ticker, day in keys]
        upsert(spark, versioned, [bar(*r) for r in rows])
        model.update({r[:2]: r for r in rows})
        if step in (2, 4):
            assert compact(spark, versioned) == [2022, 2023, 2024]
        assert prices(current_rows(spark, versioned)) == sorted(model.values())
    compact(spark, versioned)
    assert compact(spark, versioned) == []
    assert spark.sql(f"SHOW PARTITIONS {versioned}").count() == 3
    assert prices(current_rows(spark, versioned)) == sorted(model.values())


def test_readers_see_the_same_between_the_steps_of_a_compaction(spark, versioned, monkeypatch):
    upsert(spark, versioned, [bar("A", "2024-01-02", 1.0), bar("B", "2024-01-02", 1.0)])
    upsert(spark, versioned, [bar("A", "2024-01-02", 2.0)])
    before = prices(current_rows(spark, versioned))
    run = type(spark).sql

    def breaks(self, text, *args, **kwargs):
        if "DROP IF EXISTS" in text:
            raise RuntimeError("lost")
        return run(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", breaks)
    with pytest.raises(RuntimeError):
        compact(spark, versioned)
    monkeypatch.undo()
    assert prices(current_rows(spark, versioned)) == before
    assert compact(spark, versioned) == [2024]
    assert prices(current_rows(spark, versioned)) == before


def test_files_of_a_broken_upsert_are_not_seen(spark, versioned, tmp_path):
    upsert(spark, versioned, [bar("A", "2024-01-02", 1.0)])
    stray = spark.createDataFrame([bar("A", "2024-01-02", 9.0)], BARS)
    for year in (2023, 2024):
        stray.write.parquet(str(tmp_path / f"versions/year={year}/version=2"))
    assert prices(current_rows(spark, versioned)) == [("A", "2024-01-02", 1.0)]
    assert upsert(spark, versioned, [bar("B", "2024-01-02", 2.0)]) == 2
    assert prices(current_rows(spark, versioned)) == [("A", "2024-01-02", 1.0), ("B", "2024-01-02", 2.0)]


def test_an_upsert_writes_its_own_rows_only(spark, versioned, tmp_path):
    days = [f"2024-{m:02}-{d:02}" for m in range(1, 13) for d in range(1, 29)]
    upsert(spark, versioned, [bar(t, day, 1.0) for t in "ABCDEFGH" for day in days])
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "versions").rglob("*.parquet")}
    upsert(spark, versioned, [bar("A", "2024-05-05", 2.0)])
    now = {f: f.stat().st_mtime_ns for f in (tmp_path / "versions").rglob("*.parquet")}
    assert {f: now[f] for f in files} == files and len(now) == len(files) + 1


def test_newest_rows_and_windows_by_ticker_need_no_shuffle(spark, versioned):
    upsert(spark, versioned, [bar(t, f"2024-01-0{d}", 1.0) for t in "ABCD" for d in range(1, 9)])
    upsert(spark, versioned, [bar("A", "2024-01-05", 2.0)])
    days = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        metrics = range_extremes(current_rows(spark, versioned), *days, unique_days=True)
        plan = metrics._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Bucketed: true" in plan and "Exchange" not in plan
    assert metrics.count() == 32
