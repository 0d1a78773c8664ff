"""Date requests: which days a run reads, and which days it must recompute."""

import datetime as dt
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from barkeep.schema import SPAN_DAYS

# Names and defaults of the date requests.
MARKET_ZONE = "America/New_York"
STAGING_LOOKBACK_DAYS = 5
LOADER_DAYS_AGO = 1
LOADER_LOOKBACK_DAYS = 1
OUTPUT = "output"
DAILY_IMPACTED = "daily_impacted"
BOTH_SIDES = "both_sides"
# Our own: the newest days, added to metrics that are complete up to them.
NEW_DAYS = "new_days"


def parse_day(value):
    """A date from ``YYYY-MM-DD`` text; a malformed bound fails before any job runs."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(value, "%Y-%m-%d").date()


@dataclass(frozen=True)
class DayRange:
    """Inclusive range of calendar days."""

    start: dt.date
    end: dt.date

    def __post_init__(self):
        if self.end < self.start:
            raise ValueError(f"end {self.end} is before start {self.start}")

    @classmethod
    def of(cls, start, end=None):
        first = parse_day(start)
        return cls(first, first if end is None else parse_day(end))

    def widen(self, before=0, after=0):
        return DayRange(
            self.start - dt.timedelta(days=before), self.end + dt.timedelta(days=after)
        )

    def __len__(self):
        return (self.end - self.start).days + 1

    def days(self):
        return [self.start + dt.timedelta(days=i) for i in range(len(self))]

    def contains(self, column):
        """Predicate ``start <= column <= end`` on a date column."""
        return F.col(column).between(F.lit(self.start), F.lit(self.end))

    def calendar(self, spark, column="trade_date"):
        """One row per day."""
        bounds = F.sequence(F.lit(self.start), F.lit(self.end))
        return spark.range(1).select(F.explode(bounds).alias(column))


def days_back(last, lookback_days):
    """``lookback_days`` days (at least one) ending on ``last``."""
    earlier = lookback_days - 1 if lookback_days > 1 else 0
    return DayRange(last, last).widen(before=earlier)


def _today(zone, now):
    return (now or dt.datetime.now(dt.timezone.utc)).astimezone(ZoneInfo(zone)).date()


def staging_request(
    start_date=None, end_date=None, trade_date=None, lookback_days=None, zone=MARKET_ZONE, now=None
):
    """Days a daily run looks at: an explicit range, one day, or the last few days."""
    if start_date and end_date:
        return DayRange.of(start_date, end_date)
    if trade_date:
        return DayRange.of(trade_date)
    lookback = STAGING_LOOKBACK_DAYS if lookback_days is None else lookback_days
    if lookback < 1:
        raise ValueError("lookback_days must be at least 1")
    return days_back(_today(zone, now) - dt.timedelta(days=1), lookback)


def loader_request(
    trade_date=None,
    days_ago=LOADER_DAYS_AGO,
    lookback_days=LOADER_LOOKBACK_DAYS,
    zone=MARKET_ZONE,
    now=None,
):
    """Days the relational load looks at, ending on ``trade_date`` or ``days_ago``."""
    if trade_date:
        last = parse_day(trade_date)
    else:
        last = _today(zone, now) - dt.timedelta(days=days_ago)
    return days_back(last, lookback_days)


def output_range(start, end, mode=OUTPUT):
    """Days whose metrics a run writes.

    ``output`` takes the range as given. ``daily_impacted`` is for new newest days:
    earlier days see them in their leading year. ``both_sides`` is for re-loaded
    old days, which later days also see in their trailing year.
    """
    days = DayRange.of(start, end)
    if mode == OUTPUT:
        return days
    if mode == DAILY_IMPACTED:
        return days.widen(before=SPAN_DAYS)
    if mode == BOTH_SIDES:
        return days.widen(before=SPAN_DAYS, after=SPAN_DAYS)
    raise ValueError(f"unknown date range mode: {mode}")


def bounded(df, start=None, end=None, column="trade_date"):
    """Optional inclusive bounds on a date column."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(parse_day(start)))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(parse_day(end)))
    return df
