"""Curated bars to the 52-week metrics table."""

from pyspark.sql import functions as F

from barkeep.functions.ranges import DAILY_IMPACTED, NEW_DAYS, OUTPUT, DayRange, output_range
from barkeep.operators.extremes import new_day_extremes, raised_by_new_days, range_extremes
from barkeep.operators.merge import duplicate_keys
from barkeep.schema import BAR_COLUMNS, BAR_KEY, SPAN_DAYS
from barkeep.sinks.tables import create_metrics_table
from barkeep.sinks.upsert import upsert_table


def update_metrics(spark, bars_table, metrics_table, start, end, mode=OUTPUT, unique_days=False):
    """Compute the metrics of the output range and upsert them; returns the range.

    Rows whose bar has left the bars table stay in the metrics table. For the mode ``new_days`` see
    ``extend_metrics``.
    """
    if mode == NEW_DAYS:
        return extend_metrics(spark, bars_table, metrics_table, start, end)
    days = output_range(start, end, mode)
    create_metrics_table(spark, metrics_table)
    bars = spark.table(bars_table)
    if not unique_days:
        # One pre-aggregated count decides for the plan with a single shuffle by ticker.
        padded = bars.filter(days.widen(SPAN_DAYS, SPAN_DAYS).contains("trade_date"))
        unique_days = duplicate_keys(padded, list(BAR_KEY)).isEmpty()
    metrics = range_extremes(bars, days.start, days.end, unique_days)
    upsert_table(metrics_table, metrics, already_unique=unique_days)
    return days


def extend_metrics(spark, bars_table, metrics_table, start, end):
    """Metrics of the newest days, ``start`` to ``end``, and what these bars change in the year before.

    Of these days the first ones may have their metrics already, as a daily run looks a few days back. From
    the first day on that differs from the bars, days are added: the old year's rows are read and compared with
    the new bars, and only the new days go through a window. Where that does not hold (a row of the
    year before is missing or restated, a later day has rows, a ticker two bars a day) the days are
    recomputed as ``daily_impacted``, so the result is the same in any case. Returns the range written, None
    if there was nothing to do.
    """
    asked = DayRange.of(start, end)
    create_metrics_table(spark, metrics_table)
    bars, metrics = spark.table(bars_table), spark.table(metrics_table)
    first = _first_difference(bars, metrics, asked)
    if first is None:
        return None
    if first < asked.start or not _only_appends(bars, metrics, first, asked.end):
        return update_metrics(spark, bars_table, metrics_table, start, end, DAILY_IMPACTED)
    fresh = new_day_extremes(bars, first, asked.end)
    raised = raised_by_new_days(metrics, bars, first, asked.end)
    upsert_table(metrics_table, raised.unionByName(fresh), already_unique=True)
    return output_range(first, asked.end, DAILY_IMPACTED)


def _first_difference(bars, metrics, asked):
    """First day of ``asked`` and the year before whose bars and metrics rows are not of the same bars."""
    days = asked.widen(before=SPAN_DAYS)

    def summed(df, name):
        # A count and a sum of hashes per day: partial aggregation leaves a few hundred rows.
        mark = F.xxhash64(*BAR_COLUMNS) % 2**31
        marks = F.struct(F.count("*").alias("rows"), F.sum(mark).alias("mark")).alias(name)
        return df.filter(days.contains("trade_date")).groupBy("trade_date").agg(marks)

    both = summed(bars, "bars").join(summed(metrics, "metrics"), "trade_date", "full")
    return both.filter(~F.col("bars").eqNullSafe(F.col("metrics"))).agg(F.min("trade_date").alias("day")).first().day


def _only_appends(bars, metrics, first, last):
    new = DayRange(first, last)
    padded = bars.filter(new.widen(before=SPAN_DAYS).contains("trade_date"))
    return (
        len(new) <= SPAN_DAYS
        and metrics.filter(F.col("trade_date") >= F.lit(first)).isEmpty()
        and bars.filter(F.col("trade_date") > F.lit(last)).isEmpty()
        and duplicate_keys(padded, list(BAR_KEY)).isEmpty()
    )
