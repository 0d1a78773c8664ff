"""Trailing and leading 52-week highs and lows per ticker."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from barkeep.functions.columns import day_number
from barkeep.functions.ranges import DayRange
from barkeep.schema import BAR_COLUMNS, METRIC_COLUMNS, SPAN_DAYS


def _with_extremes(days):
    """Extremes for rows that are unique by ticker and day.

    A ticker then has at most one row per calendar day of the padded range, which
    bounds every window group. The frames count calendar days, not rows.
    """
    by_day = Window.partitionBy("ticker").orderBy("trade_day")
    trailing = by_day.rangeBetween(-SPAN_DAYS, 0)
    leading = by_day.rangeBetween(1, SPAN_DAYS)
    year_ago = by_day.rangeBetween(-SPAN_DAYS, -SPAN_DAYS)

    framed = days.withColumn("trade_day", day_number("trade_date")).select(
        "*",
        F.max("high").over(trailing).alias("trailing_high"),
        F.min("low").over(trailing).alias("trailing_low"),
        F.max("high").over(leading).alias("future_high_52_weeks"),
        F.min("low").over(leading).alias("future_low_52_weeks"),
        # The trailing year is complete when it reaches back to its very first
        # day, that is when a bar exists exactly SPAN_DAYS earlier. A one-day
        # frame tells, without walking the year for a minimum date.
        (F.count("trade_day").over(year_ago) > 0).alias("complete"),
    )
    complete = F.col("complete")
    return framed.withColumn(
        "past_high_52_weeks", F.when(complete, F.col("trailing_high"))
    ).withColumn("past_low_52_weeks", F.when(complete, F.col("trailing_low")))


def _lending(bars, output):
    """``bars`` with only ticker, day, high and low outside of ``output``.

    Rows around the range lend their highs and lows and are not written themselves: the nulls take next to no room in
    the shuffle.
    """
    lent = ("ticker", "trade_date", "high", "low")
    wanted = output.contains("trade_date")
    return bars.select(*[F.col(c) if c in lent else F.when(wanted, F.col(c)).alias(c) for c in BAR_COLUMNS])


def range_extremes(bars, start, end, unique_days=False):
    """52-week extremes of the bars dated ``start`` to ``end``.

    ``bars`` is read from SPAN_DAYS before to SPAN_DAYS after the range, so the
    filter prunes the partitions of a table laid out by trade_date.

    With ``unique_days`` the caller vouches for one bar per ticker and day (the
    output of a dedup); one shuffle by ticker is then enough. Otherwise the bars
    are first reduced to one high and low per ticker and day, with partial
    aggregation before the shuffle, and the extremes are joined back to every bar.
    """
    output = DayRange.of(start, end)
    padded = bars.filter(output.widen(SPAN_DAYS, SPAN_DAYS).contains("trade_date"))

    if unique_days:
        metrics = _with_extremes(_lending(padded, output)).filter(output.contains("trade_date"))
        return metrics.select(*METRIC_COLUMNS)

    days = padded.groupBy("ticker", "trade_date").agg(
        F.max("high").alias("high"), F.min("low").alias("low")
    )
    extremes = (
        _with_extremes(days).filter(output.contains("trade_date")).drop("high", "low")
    )
    wanted = bars.filter(output.contains("trade_date"))
    # Bars without a ticker meet their own days as well.
    extremes = extremes.withColumnsRenamed({"trade_date": "_day", "ticker": "_ticker"})
    same = (F.col("trade_date") == F.col("_day")) & F.col("ticker").eqNullSafe(F.col("_ticker"))
    return wanted.join(extremes, same).select(*METRIC_COLUMNS)


def new_day_extremes(bars, start, end):
    """52-week extremes of the bars dated ``start`` to ``end``, the newest there are, unique by ticker and day.

    The bars within a year of every new day are the same for all of them, and go into one high and low per ticker by
    plain aggregation. A window is left only over the new days and as many days a year earlier,
    by which the trailing years differ.
    """
    output = DayRange.of(start, end)
    if len(output) > SPAN_DAYS:
        raise ValueError(f"{len(output)} new days have no year in common: use range_extremes")
    core = bars.filter(
        (F.col("trade_date") >= F.date_sub(F.lit(output.end), SPAN_DAYS)) & (F.col("trade_date") < F.lit(output.start))
    )
    core = core.groupBy(F.col("ticker").alias("_ticker")).agg(
        F.max("high").alias("core_high"), F.min("low").alias("core_low")
    )
    # Up to the first day of the core, which tells whether the last new day's year is complete.
    shifted = DayRange(*(day - dt.timedelta(days=SPAN_DAYS) for day in (output.start, output.end)))
    near = bars.filter(shifted.contains("trade_date") | output.contains("trade_date"))
    framed = _with_extremes(_lending(near, output)).filter(output.contains("trade_date"))
    joined = framed.join(core, F.col("ticker").eqNullSafe(F.col("_ticker")), "left")
    for name, pick in (("high", F.greatest), ("low", F.least)):
        past = pick(f"trailing_{name}", f"core_{name}")
        joined = joined.withColumn(f"past_{name}_52_weeks", F.when(F.col("complete"), past))
    return joined.select(*METRIC_COLUMNS)


def raised_by_new_days(metrics, bars, start, end):
    """Rows of ``metrics`` in the year before ``start`` whose leading year meets a bar dated ``start`` to ``end``.

    Their highs and lows ahead are the old ones or those of the new bars within reach, whichever is further out.
    ``bars`` are unique by ticker and day. The running highs and lows of the new bars are looked up
    by the last day in reach; no window covers the old year.
    """
    new = DayRange.of(start, end)
    running = Window.partitionBy("ticker").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy("ticker").orderBy("trade_date")
    # Until the day before the ticker's next new bar, a bar is the last one in reach.
    until = F.coalesce(F.date_sub(F.lead("trade_date").over(onward), 1), F.lit(new.end))
    reach = bars.filter(new.contains("trade_date")).select(
        F.col("ticker").alias("_ticker"),
        F.max("high").over(running).alias("new_high"),
        F.min("low").over(running).alias("new_low"),
        "trade_date",
        until.alias("until"),
    )
    reach = reach.select("_ticker", "new_high", "new_low", F.explode(F.sequence("trade_date", "until")).alias("_reach"))
    old = metrics.filter(
        (F.col("trade_date") >= F.date_sub(F.lit(new.start), SPAN_DAYS)) & (F.col("trade_date") < F.lit(new.start))
    )
    last_in_reach = F.least(F.date_add("trade_date", SPAN_DAYS), F.lit(new.end))
    met = old.join(reach, F.col("ticker").eqNullSafe(F.col("_ticker")) & (last_in_reach == F.col("_reach")))
    return met.select(
        *[c for c in METRIC_COLUMNS if not c.startswith("future_")],
        F.greatest("future_high_52_weeks", "new_high").alias("future_high_52_weeks"),
        F.least("future_low_52_weeks", "new_low").alias("future_low_52_weeks"),
    )
