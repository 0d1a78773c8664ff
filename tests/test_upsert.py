import datetime as dt

import pytest

from barkeep.operators.merge import DuplicateKeyError, merged, require_unique
from barkeep.plans.metrics import update_metrics
from barkeep.schema import BARS
from barkeep.sinks.tables import (
    create_bars_table,
    set_table_properties,
    unset_table_properties,
    widen_column,
    write_table,
)
from barkeep.sinks.upsert import upsert_table


def bars(spark, points):
    rows = [(t, dt.date.fromisoformat(d), 0, v, 1.0, 1.0, 1.0, 1.0, 1) for t, d, v in points]
    return spark.createDataFrame(rows, BARS)


def content(spark, table):
    return sorted((r.ticker, str(r.trade_date), r.volume) for r in spark.table(table).collect())


OLD = [("A", "2024-01-02", 1.0), ("B", "2024-01-02", 1.0), ("A", "2024-01-03", 1.0), ("A", "2024-01-05", 1.0)]
NEW = [("A", "2024-01-02", 2.0), ("C", "2024-01-02", 2.0), ("A", "2024-01-04", 2.0), ("A", "2024-01-05", 2.0)]
BOTH = [
    ("A", "2024-01-02", 2.0), ("A", "2024-01-03", 1.0), ("A", "2024-01-04", 2.0),
    ("A", "2024-01-05", 2.0), ("B", "2024-01-02", 1.0), ("C", "2024-01-02", 2.0),
]


def test_update_insert_keep_and_repeat(spark, table_name):
    create_bars_table(spark, table_name)
    write_table(bars(spark, OLD), table_name)
    for _ in range(2):
        upsert_table(table_name, bars(spark, NEW))
        assert content(spark, table_name) == BOTH


def test_only_touched_days_are_rewritten(spark, table_name):
    create_bars_table(spark, table_name)
    write_table(bars(spark, OLD), table_name)

    def files(day):
        paths = spark.table(table_name).filter(f"trade_date = '{day}'").select("_metadata.file_path")
        return {r[0] for r in paths.collect()}

    kept, changed = files("2024-01-03"), files("2024-01-02")
    upsert_table(table_name, bars(spark, NEW))
    assert files("2024-01-03") == kept and files("2024-01-02") != changed


def test_repeated_keys_are_refused_before_the_table_is_touched(spark, table_name):
    create_bars_table(spark, table_name)
    write_table(bars(spark, OLD), table_name)
    with pytest.raises(DuplicateKeyError, match="ticker=A, trade_date=2024-01-04 .2 rows."):
        upsert_table(table_name, bars(spark, [*NEW, ("A", "2024-01-04", 3.0)]))
    assert content(spark, table_name) == sorted(OLD)


def test_no_rows_and_wrong_keys(spark, table_name):
    create_bars_table(spark, table_name)
    write_table(bars(spark, OLD), table_name)
    upsert_table(table_name, bars(spark, []))
    assert content(spark, table_name) == sorted(OLD)
    with pytest.raises(ValueError, match="must be one of the keys"):
        upsert_table(table_name, bars(spark, NEW), keys=("ticker",))


def test_merged_on_another_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    new = spark.createDataFrame([(2, "x"), (3, "y")], "id long, v string")
    assert sorted(map(tuple, merged(old, new, ["id"]).collect())) == [(1, "a"), (2, "x"), (3, "y")]
    require_unique(new, ["id"])


def test_widen_column(spark, table_name):
    spark.sql(
        f"CREATE TABLE {table_name} (ticker string, volume bigint, trade_date date)"
        " USING parquet PARTITIONED BY (trade_date)"
    )
    values = "('A', 5, date'2024-01-02'), ('B', NULL, date'2024-01-03')"
    spark.sql(f"INSERT INTO {table_name} VALUES {values}")
    assert widen_column(spark, table_name, "volume", "double")
    assert dict(spark.table(table_name).dtypes)["volume"] == "double"
    assert sorted((r.ticker, r.volume) for r in spark.table(table_name).collect()) == [("A", 5.0), ("B", None)]
    assert [c.name for c in spark.catalog.listColumns(table_name) if c.isPartition] == ["trade_date"]
    assert not widen_column(spark, table_name, "volume", "double")


def test_create_twice_and_table_properties(spark, table_name):
    for _ in range(2):
        create_bars_table(spark, table_name)
    assert dict(spark.table(table_name).dtypes)["volume"] == "double"

    def properties():
        return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table_name}").collect()}

    set_table_properties(spark, table_name, {"write.data.path": "/data"})
    assert properties()["write.data.path"] == "/data"
    unset_table_properties(spark, table_name, ["write.data.path"])
    assert "write.data.path" not in properties()


def test_metrics_of_a_table_with_repeated_bars_are_refused(spark, table_name):
    source, target = f"{table_name}_bars", f"{table_name}_metrics"
    create_bars_table(spark, source)
    for _ in range(2):
        write_table(bars(spark, OLD), source, "append")
    with pytest.raises(DuplicateKeyError):
        update_metrics(spark, source, target, "2024-01-01", "2024-01-31")
