"""One key, ticker or day holding a third of all rows: results stay whole, and the
plans reduce or split it before or after the shuffle."""

import datetime as dt

from pyspark.sql import functions as F

from barkeep.operators.dedup import latest_per_key
from barkeep.operators.extremes import range_extremes
from barkeep.schema import BAR_COLUMNS
from barkeep.sinks.tables import create_bars_table, write_settings, write_table

ROWS = 30_000


def skewed(spark):
    """A third of the rows share one ticker and day; the rest are spread."""
    n = F.col("id")
    hot = n % 3 == 0
    day = F.date_add(F.lit(dt.date(2023, 1, 1)), F.when(hot, 5).otherwise(n % 500).cast("int"))
    return spark.range(ROWS, numPartitions=6).select(
        F.when(hot, "HOT").otherwise(F.concat(F.lit("T"), n % 40)).alias("ticker"),
        day.alias("trade_date"),
        n.alias("window_start"),
        *[(n % 997).cast("double").alias(c) for c in ("volume", "open", "close", "high", "low")],
        n.alias("transactions"),
    ).select(*BAR_COLUMNS)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan()


def test_dedup_sends_one_row_per_key_and_task(spark):
    df = latest_per_key(skewed(spark))
    expected = skewed(spark).groupBy("ticker", "trade_date").agg(F.max("window_start").alias("w"))
    assert df.count() == expected.count()
    assert df.filter("ticker = 'HOT'").first().window_start == ROWS - 3


def test_repeated_days_are_reduced_before_the_windows(spark):
    df = range_extremes(skewed(spark), "2023-01-01", "2024-12-31")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(high" in plan and "partial_min(low" in plan
    assert df.count() == ROWS
    hot = df.filter("ticker = 'HOT'").select("future_high_52_weeks").distinct().collect()
    assert [r[0] for r in hot] == [None]


def test_a_large_day_is_written_by_several_tasks(spark, table_name):
    create_bars_table(spark, table_name)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    from barkeep.sinks import tables

    before = tables.WRITE_SETTINGS[size]
    tables.WRITE_SETTINGS[size] = "64k"
    try:
        write_table(skewed(spark), table_name)
    finally:
        tables.WRITE_SETTINGS[size] = before
    assert spark.table(table_name).count() == ROWS
    files = spark.table(table_name).filter("trade_date = '2023-01-06'")
    assert files.select("_metadata.file_path").distinct().count() > 1
    with write_settings(spark):
        assert spark.conf.get(size) == before
