import datetime as dt
import math
import random

import pytest

from barkeep.functions.ranges import BOTH_SIDES, DAILY_IMPACTED, output_range
from barkeep.operators.extremes import range_extremes
from barkeep.schema import BARS, METRIC_COLUMNS, SPAN_DAYS

DAY0 = dt.date(2022, 1, 3)
FAR = ("2015-01-01", "2030-01-01")


def bars(spark, points):
    """points: (ticker, days after DAY0, high, low)."""
    rows = [
        (t, DAY0 + dt.timedelta(days=d), 0, 1.0, 1.0, 1.0, high, low, 1) for t, d, high, low in points
    ]
    return spark.createDataFrame(rows, BARS)


def result(df):
    """{(ticker, days after DAY0): (past high, past low, future high, future low)}"""
    return {
        (r.ticker, (r.trade_date - DAY0).days): tuple(r)[-4:]
        for r in df.select("ticker", "trade_date", *METRIC_COLUMNS[-4:]).collect()
    }


def brute_force(points, first=None, last=None):
    out = []
    for t, d, _, _ in points:
        past = [p for p in points if p[0] == t and d - SPAN_DAYS <= p[1] <= d]
        later = [p for p in points if p[0] == t and d < p[1] <= d + SPAN_DAYS]
        complete = any(p[1] == d - SPAN_DAYS for p in past)

        def pick(rows, i, choose):
            values = [p[i] for p in rows if p[i] is not None]
            return choose(values) if values else None

        row = (
            pick(past, 2, max) if complete else None,
            pick(past, 3, min) if complete else None,
            pick(later, 2, max),
            pick(later, 3, min),
        )
        if (first is None or d >= first) and (last is None or d <= last):
            out.append((t, d, *row))
    return sorted(out, key=str)


def flat(df):
    return sorted(
        [
            (r.ticker, (r.trade_date - DAY0).days, *tuple(r)[-4:])
            for r in df.select("ticker", "trade_date", *METRIC_COLUMNS[-4:]).collect()
        ],
        key=str,
    )


def random_points(seed, repeated=False):
    rng = random.Random(seed)
    points = []
    for t in ("A", "B", "C"):
        days = sorted(rng.sample(range(900), 150 if t != "C" else 3))
        for d in days:
            for _ in range(rng.choice([1, 1, 3]) if repeated else 1):
                high = None if rng.random() < 0.1 else float(rng.randint(50, 99))
                points.append((t, d, high, float(rng.randint(1, 49))))
    return points


def test_golden_cases(spark):
    points = [
        ("FULL", 0, 9.0, 1.0), ("FULL", 364, 5.0, 2.0),
        ("GAP", 0, 9.0, 1.0), ("GAP", 1, 8.0, 1.5), ("GAP", 366, 5.0, 2.0),
        ("FAR", 0, 9.0, 1.0), ("FAR", 365, 5.0, 2.0),
        ("HOLE", 0, None, 1.0), ("HOLE", 364, 5.0, 2.0),
    ]
    got = result(range_extremes(bars(spark, points), *FAR, unique_days=True))
    assert got["FULL", 0] == (None, None, 5.0, 2.0)
    assert got["FULL", 364] == (9.0, 1.0, None, None)
    # 365 and 363 days back, nothing exactly 364 days back: not a complete year.
    assert got["GAP", 366][:2] == (None, None)
    assert got["FAR", 0] == (None, None, None, None)
    assert got["HOLE", 364] == (5.0, 1.0, None, None)


def test_not_a_number_is_the_largest(spark):
    points = [("N", 0, math.nan, 1.0), ("N", 364, 5.0, 2.0)]
    got = result(range_extremes(bars(spark, points), *FAR, unique_days=True))
    assert math.isnan(got["N", 364][0])


@pytest.mark.parametrize("unique_days", [True, False])
def test_against_brute_force(spark, unique_days):
    points = random_points(1)
    got = range_extremes(bars(spark, points), *FAR, unique_days=unique_days)
    assert flat(got) == brute_force(points)


def test_repeated_days_against_brute_force(spark):
    points = random_points(2, repeated=True)
    assert flat(range_extremes(bars(spark, points), *FAR)) == brute_force(points)


def test_a_split_range_equals_the_whole(spark):
    points = random_points(3)
    rows = bars(spark, points).repartition(7).cache()
    day = [DAY0 + dt.timedelta(days=n) for n in (0, 299, 300, 899)]
    whole = flat(range_extremes(rows, day[0], day[3], unique_days=True))
    halves = flat(range_extremes(rows, day[0], day[1], unique_days=True)) + flat(
        range_extremes(rows, day[2], day[3], unique_days=True)
    )
    assert sorted(halves, key=str) == whole == brute_force(points)


def test_one_shuffle_and_pruned_days(spark):
    df = range_extremes(bars(spark, random_points(4)), "2022-06-01", "2022-06-30", unique_days=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "2021-06-02" in plan and "2023-06-29" in plan


def test_output_range_modes():
    day = dt.date
    assert output_range("2024-01-02", "2024-01-05").start == day(2024, 1, 2)
    impacted = output_range("2024-01-02", "2024-01-05", DAILY_IMPACTED)
    assert (impacted.start, impacted.end) == (day(2023, 1, 3), day(2024, 1, 5))
    both = output_range("2024-01-02", "2024-01-05", BOTH_SIDES)
    assert (both.start, both.end) == (day(2023, 1, 3), day(2025, 1, 3))
    with pytest.raises(ValueError, match="unknown date range mode"):
        output_range("2024-01-02", "2024-01-05", "weekly")
    with pytest.raises(ValueError, match="before start"):
        output_range("2024-01-05", "2024-01-02")


def test_reloading_an_old_day_needs_both_sides(spark):
    """daily_impacted leaves the following year's past_* stale, both_sides does not."""
    old = [("A", d, 10.0, 5.0) for d in range(0, 800, 4)]
    new = [(t, d, 99.0 if d == 400 else h, low) for t, d, h, low in old]
    start = DAY0 + dt.timedelta(days=400)
    before = dict(((r[0], r[1]), r) for r in flat(range_extremes(bars(spark, old), *FAR, unique_days=True)))
    after = dict(((r[0], r[1]), r) for r in flat(range_extremes(bars(spark, new), *FAR, unique_days=True)))
    changed = {k for k in after if after[k] != before[k]}

    def covered(mode):
        days = output_range(start, start, mode)
        return {k for k in changed if days.start <= DAY0 + dt.timedelta(days=k[1]) <= days.end}

    assert covered(BOTH_SIDES) == changed
    assert covered(DAILY_IMPACTED) < changed
