"""Bars matched with the date ranges that cover them."""

from pyspark.sql import functions as F


def range_days(ranges):
    """One row per range and day: (range_id, trade_date)."""
    days = F.explode(F.sequence("start_date", "end_date"))
    return ranges.filter(F.col("start_date") <= F.col("end_date")).select(
        "range_id", days.alias("trade_date")
    )


def match_ranges(bars, ranges):
    """Every bar once per range with ``start_date <= trade_date <= end_date``.

    Listing each range's days turns the range condition into an equality, so Spark
    can hash or broadcast by day (and split a skewed day) instead of comparing
    every bar with every range.
    """
    return bars.join(range_days(ranges), "trade_date")


def count_by_range(bars, ranges):
    """Bars per range; ranges without bars count 0.

    Bars are counted by day before the join, which then works on one row per day.
    """
    per_day = bars.groupBy("trade_date").agg(F.count("*").alias("bars"))
    matched = match_ranges(per_day, ranges).groupBy("range_id").agg(F.sum("bars").alias("bars"))
    return ranges.join(matched, "range_id", "left").withColumn(
        "bars", F.coalesce("bars", F.lit(0))
    )
