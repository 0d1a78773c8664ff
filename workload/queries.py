"""One query per operator, over the whole of the given tables."""

import datetime as dt

from pyspark.sql import functions as F

from barkeep.functions.columns import raw_key, utc_date
from barkeep.functions.ranges import (
    BOTH_SIDES,
    DAILY_IMPACTED,
    NEW_DAYS,
    DayRange,
    bounded,
    loader_request,
    output_range,
    staging_request,
)
from barkeep.operators import counters, manifest, merge, profile
from barkeep.operators.dedup import latest_per_key
from barkeep.operators.extremes import range_extremes
from barkeep.operators.normalize import normalize_text, normalize_typed
from barkeep.operators.ranges import count_by_range
from barkeep.plans.backfill import backfill, resumable_backfill
from barkeep.plans.daily import daily_update
from barkeep.plans.load import (
    bars_from_raw,
    bars_from_text,
    load_bars,
    load_relational,
    refresh_bars,
    staged_text,
)
from barkeep.plans.metrics import update_metrics
from barkeep.plans.quarantine import load_checked
from barkeep.schema import METRICS, RAW_COLUMNS
from barkeep.scratch import fresh_dir
from barkeep.sinks.relational import read_relational
from barkeep.sinks.tables import (
    APPEND,
    create_metrics_table,
    set_table_properties,
    unset_table_properties,
    widen_column,
    write_latest,
    write_table,
)
from barkeep.sinks.upsert import upsert_table
from barkeep.sinks.versions import (
    compact,
    create_current_view,
    create_versioned_table,
    current_rows,
    upsert_version,
)
from barkeep.sources.raw_files import (
    list_files,
    monthly_ranges,
    read_inferred,
    read_ranges,
    read_table,
    scan_bars,
    scan_text,
    write_ranges,
)
from barkeep.streaming.ingest import ingest_new_files
from barkeep.streaming.keyed import ingest_keyed
from workload.inputs import (
    bars,
    bars_table,
    event_zone,
    fresh_table,
    raw_bars,
    raw_zone,
    table,
    write_day_files,
)

# The days loaded a second time, or asked for, in the queries about ranges.
SOME_DAYS = ("1997-03-01", "1998-02-28")
# Days that a daily run asks for: the last one that is known, and half a year after it.
NEW_DAYS_ASKED = ("1997-03-01", "1997-08-31")
EVENT_DAYS = DayRange.of("2023-12-25", "2024-02-05")
FILES_PER_BATCH = 1000
# The month whose files lack a column in the query about failing ranges.
BAD_MONTH = "1997-04-01"

# Database for the relational load. Unset, an in-memory one inside the driver
# process is used, which executors can reach only in local mode.
URL_SETTING = "spark.barkeep.jdbc.url"


def all_days(spark, sf_dir):
    """First and last day of the bars."""
    day = F.col("l_shipdate").cast("date")
    span = table(spark, sf_dir, "lineitem").agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return tuple(span.first())


def metrics_52w(spark, sf_dir):
    return range_extremes(bars(spark, sf_dir), *all_days(spark, sf_dir), unique_days=True)


def metrics_52w_repeated_days(spark, sf_dir):
    repeated = normalize_typed(raw_bars(spark, sf_dir))
    return range_extremes(repeated, *all_days(spark, sf_dir))


def metrics_52w_daily_impacted(spark, sf_dir):
    days = output_range(*SOME_DAYS, DAILY_IMPACTED)
    return range_extremes(bars(spark, sf_dir), days.start, days.end, unique_days=True)


def metrics_52w_both_sides(spark, sf_dir):
    days = output_range(*SOME_DAYS, BOTH_SIDES)
    return range_extremes(bars(spark, sf_dir), days.start, days.end, unique_days=True)


def metrics_52w_full_flag_only(spark, sf_dir):
    metrics = metrics_52w(spark, sf_dir)
    return metrics.filter(F.col("past_high_52_weeks").isNotNull()).select("ticker", "trade_date")


def bars_normalized(spark, sf_dir):
    return normalize_typed(raw_bars(spark, sf_dir))


def bars_dedup_latest(spark, sf_dir):
    return bars(spark, sf_dir)


def bars_date_range(spark, sf_dir):
    return bounded(bars(spark, sf_dir), *SOME_DAYS)


def bars_text_normalized(spark, sf_dir):
    """Bars as text with some cells blank, through CSV files and back."""
    text = raw_bars(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS])
    volume, lots = F.col("volume").cast("double"), F.col("open").cast("double")
    blanked = text.select(
        F.when(lots > 50000, F.lit("")).otherwise(F.col("ticker")).alias("ticker"),
        F.when(volume < 5, F.lit("")).otherwise(F.col("volume")).alias("volume"),
        *RAW_COLUMNS[2:],
    )
    path = fresh_dir(spark, "text")
    blanked.write.option("header", True).option("compression", "gzip").csv(path)
    return normalize_text(scan_text(spark, path)).drop("file_day")


def bars_text_load(spark, sf_dir):
    return bars_from_text(scan_text(spark, raw_zone(spark, sf_dir), one_header=True))


def bars_text_days(spark, sf_dir):
    """Text load of the day files of a date range; days without a file are skipped."""
    days = DayRange.of(*SOME_DAYS)
    return bars_from_text(scan_text(spark, raw_zone(spark, sf_dir), days))


def bars_csv_roundtrip(spark, sf_dir):
    return bars_from_raw(scan_bars(spark, raw_zone(spark, sf_dir)))


def bars_csv_pruned(spark, sf_dir):
    raw = scan_bars(spark, raw_zone(spark, sf_dir), DayRange.of(*SOME_DAYS))
    return bars_from_raw(raw, *SOME_DAYS)


def bars_load(spark, sf_dir):
    name = bars_table(spark, "load")
    load_bars(spark, raw_zone(spark, sf_dir), name)
    return read_table(spark, name)


def bars_overwrite_partitions(spark, sf_dir):
    """Some days replaced by fewer, changed rows; all other days stay."""
    rows = bars(spark, sf_dir)
    name = bars_table(spark, "overwrite", rows)
    changed = bounded(rows, *SOME_DAYS).filter("volume > 10").withColumn("volume", F.col("volume") * 2)
    write_table(changed, name)
    write_table(changed.filter("volume < 0"), name)
    return read_table(spark, name)


def bars_append(spark, sf_dir):
    rows = bars(spark, sf_dir)
    name = bars_table(spark, "append", rows)
    write_table(bounded(rows, *SOME_DAYS), name, APPEND)
    return read_table(spark, name)


def bars_volume_widened(spark, sf_dir):
    """A table whose volume is still a bigint, given the type it has today."""
    name, location = fresh_table(spark, "widened")
    spark.sql(
        f"CREATE TABLE {name} (ticker string, trade_date date, window_start bigint,"
        " volume bigint, open double, close double, high double, low double,"
        " transactions bigint) USING parquet PARTITIONED BY (trade_date)"
        f" LOCATION '{location}'"
    )
    write_table(bars(spark, sf_dir).withColumn("volume", F.col("volume").cast("long")), name)
    widen_column(spark, name, "volume", "double", f"{location}-double")
    return read_table(spark, name)


def metrics_upsert(spark, sf_dir):
    """Metrics of the bars known by some day, then updated when all bars are there."""
    # Brought together by ticker for the dedup and the windows alike.
    rows = latest_per_key(normalize_typed(raw_bars(spark, sf_dir)), cluster_by=("ticker",))
    name, location = fresh_table(spark, "metrics")
    create_metrics_table(spark, name, location)
    today = SOME_DAYS[0]
    first, last = all_days(spark, sf_dir)
    write_table(range_extremes(bounded(rows, end=today), first, today, unique_days=True), name)
    days = output_range(today, last, DAILY_IMPACTED)
    upsert_table(name, range_extremes(rows, days.start, days.end, unique_days=True), already_unique=True)
    return read_table(spark, name)


def orders_upsert(spark, sf_dir):
    """Expensive orders get a new price, and each of them a copy under a new key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    dear = orders.filter("o_totalprice > 250000")
    repriced = dear.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    copies = dear.withColumn("o_orderkey", -F.col("o_orderkey"))
    return merge.merged(orders, repriced.unionByName(copies), ["o_orderkey"])


def orders_duplicate_keys(spark, sf_dir):
    """The check before an upsert, on a key that does repeat."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return merge.duplicate_keys(items, ["l_orderkey", "l_suppkey"])


def bars_upsert_jdbc(spark, sf_dir):
    """Text files into a relational table, twice for some days."""
    url = spark.conf.get(URL_SETTING, None)
    if url is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {URL_SETTING} to a database all executors can reach")
        system = spark.sparkContext._jvm.java.lang.System
        system.setProperty("derby.stream.error.file", "/dev/null")
        url = "jdbc:derby:memory:barkeep;create=true"
    name, _ = fresh_table(spark, "daily")
    name = name[:20]
    target = (raw_zone(spark, sf_dir), url, "market", name)
    load_relational(spark, *target, one_header=True)
    load_relational(spark, *target, days=DayRange.of(*SOME_DAYS), one_header=True)
    rows = read_relational(spark, *target[1:])
    lower = rows.select(*[F.col(c).alias(c.lower()) for c in rows.columns])
    return lower.drop("loaded_at")


def staging_manifest(spark, sf_dir):
    files = list_files(spark, event_zone(spark, sf_dir), EVENT_DAYS)
    return manifest.staging_manifest(files, EVENT_DAYS).select("trade_date", "status")


def staging_summary(spark, sf_dir):
    root = event_zone(spark, sf_dir)
    days = manifest.staging_manifest(list_files(spark, root, EVENT_DAYS), EVENT_DAYS)
    return manifest.staging_summary(days, root).select(
        "status",
        F.array_join("available_dates", ",").alias("available_dates"),
        F.array_join("missing_dates", ",").alias("missing_dates"),
        F.size("raw_paths").cast("long").alias("files"),
        "daily_start_date",
        "daily_end_date",
    )


def staging_days_by_status(spark, sf_dir):
    files = list_files(spark, event_zone(spark, sf_dir), EVENT_DAYS)
    grouped = manifest.days_by_status(manifest.staging_manifest(files, EVENT_DAYS))
    return grouped.select("status", F.array_join("days", ",").alias("days"))


def raw_file_keys(spark, sf_dir):
    days = normalize_typed(raw_bars(spark, sf_dir)).select("trade_date").distinct()
    return days.select("trade_date", raw_key("/raw/day_bars/", "trade_date").alias("key"))


def _month_list(spark, sf_dir, root):
    """Work list with a range per month of the bars, and one whose files are missing;
    saved and read back."""
    day = F.col("l_shipdate").cast("date")
    span = table(spark, sf_dir, "lineitem").agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
    months = monthly_ranges(spark, root, DayRange(span.a, span.b))
    missing = monthly_ranges(spark, root, DayRange.of("2003-01-01", "2003-01-31"))
    path = fresh_dir(spark, "ranges")
    write_ranges(months.unionByName(missing.withColumn("range_id", F.lit(1_000_000))), path)
    return read_ranges(spark, path)


def range_list(spark, sf_dir):
    return _month_list(spark, sf_dir, "/raw").select(
        F.col("range_id").cast("long").alias("range_id"), "input_path", "start_date", "end_date"
    )


def range_bar_counts(spark, sf_dir):
    counted = count_by_range(bars(spark, sf_dir), _month_list(spark, sf_dir, "/raw"))
    return counted.select("start_date", "end_date", "bars")


def backfill_range_counts(spark, sf_dir):
    root = raw_zone(spark, sf_dir)
    name = bars_table(spark, "backfill")
    done = backfill(spark, _month_list(spark, sf_dir, root), name)
    return done.select("start_date", "end_date", "status", "bars")


def backfill_table(spark, sf_dir):
    root = raw_zone(spark, sf_dir)
    name = bars_table(spark, "backfill")
    backfill(spark, _month_list(spark, sf_dir, root), name, mode="strict")
    return read_table(spark, name)


def bars_load_counters(spark, sf_dir):
    root = raw_zone(spark, sf_dir)
    # Counted in the scan itself: nothing else needs the rows.
    rows = scan_text(spark, root, one_header=True, with_path=True)
    counted = counters.rows_per_file(list_files(spark, root), rows)
    return counted.withColumn("path", F.element_at(F.split("path", "/"), -1))


def bars_load_totals(spark, sf_dir):
    root = raw_zone(spark, sf_dir)
    raw = staged_text(spark, root)
    return counters.load_counters(list_files(spark, root), raw, bars_from_text(raw.drop("path")))


def bars_incremental_stream(spark, sf_dir):
    name = bars_table(spark, "stream")
    checkpoint = fresh_dir(spark, "stream-checkpoint")
    ingest_new_files(spark, raw_zone(spark, sf_dir), name, checkpoint, FILES_PER_BATCH)
    return read_table(spark, name)


def daily_update_metrics(spark, sf_dir):
    """All files loaded, then a daily run over the last days."""
    root = raw_zone(spark, sf_dir)
    bars_name = bars_table(spark, "daily-bars")
    metrics_name, location = fresh_table(spark, "daily-metrics")
    create_metrics_table(spark, metrics_name, location)
    load_bars(spark, root, bars_name)
    daily_update(spark, root, bars_name, metrics_name, DayRange.of(*SOME_DAYS))
    return read_table(spark, metrics_name)


def metrics_table(spark, sf_dir):
    """Metrics of a date range computed from the curated table and upserted."""
    bars_name = bars_table(spark, "bars")
    write_latest(normalize_typed(raw_bars(spark, sf_dir)), bars_name)
    name, location = fresh_table(spark, "metrics-table")
    create_metrics_table(spark, name, location)
    update_metrics(spark, bars_name, name, *all_days(spark, sf_dir))
    return read_table(spark, name)


def profile_count(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.agg(F.count("*").alias("rows"))


def profile_sample(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return profile.json_rows(events, 10, ["event_id"])


def profile_inferred(spark, sf_dir):
    """Row count and integer sum through a CSV scan with inferred types."""
    inferred = read_inferred(spark, f"{event_zone(spark, sf_dir)}/*/*")
    return inferred.groupBy("event_type").agg(
        F.count("*").alias("rows"), F.sum("user_id").alias("users")
    )


def profile_whole(spark, sf_dir):
    """The profile itself: schema tree, sample and row count of one dataset, as rows."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    found = profile.profile(events, 10, ["event_id"])
    shown = [("rows", str(found.rows)), ("columns", str(found.schema.count(" |-- ")))]
    shown += [(f"row {i}", row) for i, row in enumerate(found.sample)]
    return spark.createDataFrame(shown, "item string, value string")


def bars_exact_file(spark, sf_dir):
    """One raw file by its own path, whatever its day: the file of the last day."""
    last = all_days(spark, sf_dir)[1]
    root = raw_zone(spark, sf_dir)
    files = list_files(spark, root, DayRange(last, last)).orderBy("path")
    return bars_from_text(scan_text(spark, files.first().path))


def bars_late_rows(spark, sf_dir):
    """Bars of some days lie in files of a day months later; a load by date still finds them."""
    rows = raw_bars(spark, sf_dir)
    moved = F.add_months(utc_date("window_start"), 6)
    root = write_day_files(rows, moved, fresh_dir(spark, "late"))
    name = bars_table(spark, "late")
    load_bars(spark, root, name, *SOME_DAYS)
    return read_table(spark, name)


def bars_restated(spark, sf_dir):
    """All days loaded, then loaded again by date from a zone of restated files."""
    name = bars_table(spark, "restated")
    load_bars(spark, raw_zone(spark, sf_dir), name)
    restated = raw_bars(spark, sf_dir, by_day=True).withColumn("volume", F.col("volume") * 2)
    root = write_day_files(restated, utc_date("window_start"), fresh_dir(spark, "restated-files"), clustered=True)
    load_bars(spark, root, name, *all_days(spark, sf_dir))
    return read_table(spark, name)


def bars_late_by_ledger(spark, sf_dir):
    """Bars of some days lie in files of a day months later; the ledger knows which to open."""
    moved = F.add_months(utc_date("window_start"), 6)
    root = write_day_files(raw_bars(spark, sf_dir), moved, fresh_dir(spark, "late"))
    name, ledger = bars_table(spark, "ledgered"), fresh_table(spark, "ledger")[0]
    first, last = all_days(spark, sf_dir)
    for days in ((first, SOME_DAYS[0]), SOME_DAYS, (SOME_DAYS[1], last)):
        load_bars(spark, root, name, *days, ledger=ledger)
    return read_table(spark, name)


def bars_refreshed(spark, sf_dir):
    """Files of some days are replaced under their names, and a refresh notices."""
    root = write_day_files(raw_bars(spark, sf_dir), utc_date("window_start"), fresh_dir(spark, "replaced"))
    name, ledger = bars_table(spark, "refreshed"), fresh_table(spark, "ledger")[0]
    refresh_bars(spark, root, name, ledger)
    rows = raw_bars(spark, sf_dir).withColumn("_day", utc_date("window_start"))
    rows = rows.filter(DayRange.of(*SOME_DAYS).contains("_day")).drop("_day")
    write_day_files(rows.withColumn("volume", F.col("volume") * 2), utc_date("window_start"), root)
    refresh_bars(spark, root, name, ledger)
    return read_table(spark, name)


def metrics_new_days(spark, sf_dir):
    """Metrics of the bars up to some day, then of half a year of new days, added by the delta rule."""
    rows = bounded(bars(spark, sf_dir), end=NEW_DAYS_ASKED[1])
    bars_name = bars_table(spark, "extended-bars", bounded(rows, end=SOME_DAYS[0]))
    name, location = fresh_table(spark, "extended")
    create_metrics_table(spark, name, location)
    update_metrics(spark, bars_name, name, all_days(spark, sf_dir)[0], SOME_DAYS[0], unique_days=True)
    write_table(bounded(rows, NEW_DAYS_ASKED[0], NEW_DAYS_ASKED[1]), bars_name)
    update_metrics(spark, bars_name, name, *NEW_DAYS_ASKED, mode=NEW_DAYS)
    return read_table(spark, name)


def staging_split_days(spark, sf_dir):
    """All files of a day are named, where a day is split over two files."""
    root = event_zone(spark, sf_dir)
    files = list_files(spark, root, EVENT_DAYS)
    second = files.withColumn("path", F.regexp_replace("path", "[.]csv[.]gz$", "-1.csv.gz"))
    days = manifest.staging_manifest(files.union(second), EVENT_DAYS)
    shown = days.filter(F.col("status") == manifest.AVAILABLE)
    return shown.select(
        "trade_date",
        "files",
        F.array_join(F.transform("paths", lambda p: F.element_at(F.split(p, "/"), -1)), ",").alias("names"),
    )


def backfill_bad_range(spark, sf_dir):
    """All months as ranges, of which one month's files lack a column: it fails alone, the others are loaded."""
    rows = raw_bars(spark, sf_dir, by_day=True).withColumn("_day", utc_date("window_start"))
    root, bad = fresh_dir(spark, "ranges"), F.trunc("_day", "month") == F.lit(BAD_MONTH).cast("date")
    write_day_files(rows.filter(~bad).drop("_day"), utc_date("window_start"), root, clustered=True)
    write_day_files(rows.filter(bad).drop("_day", "high"), utc_date("window_start"), root, clustered=True)
    ranges = monthly_ranges(spark, root, DayRange(*all_days(spark, sf_dir)))
    name = bars_table(spark, "bad-range")
    done = backfill(spark, ranges, name)
    per_month = read_table(spark, name).groupBy(F.trunc("trade_date", "month").alias("month"))
    loaded = per_month.agg(F.count("*").alias("loaded"))
    return done.withColumn("month", F.trunc("start_date", "month")).join(loaded, "month", "left").select(
        "month",
        "status",
        F.col("error").isNotNull().alias("has_error"),
        F.coalesce("loaded", F.lit(0)).cast("long").alias("loaded"),
    )


def table_properties(spark, sf_dir):
    """Properties set, one unset again, and read back from a table of all bars."""
    name = bars_table(spark, "properties", bars(spark, sf_dir))
    set_table_properties(spark, name, {"barkeep.kind": "bars", "barkeep.note": "draft"})
    unset_table_properties(spark, name, ["barkeep.note", "barkeep.absent"])
    rows = read_table(spark, name).count()
    shown = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key").startswith("barkeep."))
    return shown.withColumn("rows", F.lit(rows).cast("long"))


def date_requests(spark, sf_dir):
    """Bars of the days that date requests come to, asked at a fixed time."""
    now = dt.datetime(1998, 3, 2, 3, tzinfo=dt.timezone.utc)
    requests = {
        "range": staging_request(*SOME_DAYS, now=now),
        "day": staging_request(trade_date="1997-03-05", now=now),
        "lookback": staging_request(now=now),
        "loader": loader_request(days_ago=1, lookback_days=3, now=now),
    }
    listed = [(name, days.start, days.end) for name, days in requests.items()]
    asked = spark.createDataFrame(listed, "request string, start_date date, end_date date")
    counted = count_by_range(bars(spark, sf_dir), asked.withColumn("range_id", F.monotonically_increasing_id()))
    return asked.join(counted.select("start_date", "end_date", "bars"), ["start_date", "end_date"])


def metrics_bucketed(spark, sf_dir):
    """Metrics of bars in a bucketed table, where a second version has restated the first."""
    rows = bars(spark, sf_dir)
    name, location = fresh_table(spark, "bucketed")
    create_versioned_table(spark, name, location)
    upsert_version(name, bounded(rows, end=SOME_DAYS[0]).withColumn("high", F.col("high") * 2))
    upsert_version(name, rows)
    return range_extremes(current_rows(spark, name), *all_days(spark, sf_dir), unique_days=True)


def metrics_versions(spark, sf_dir):
    """The upsert of ``metrics_upsert`` as a second version, compacted, and read through a view."""
    rows = bars(spark, sf_dir)
    name, location = fresh_table(spark, "versions")
    create_versioned_table(spark, name, location, METRICS)
    today = SOME_DAYS[0]
    first, last = all_days(spark, sf_dir)
    upsert_version(name, range_extremes(bounded(rows, end=today), first, today, unique_days=True))
    days = output_range(today, last, DAILY_IMPACTED)
    upsert_version(name, range_extremes(rows, days.start, days.end, unique_days=True))
    compact(spark, name)
    create_current_view(spark, f"{name}_now", name)
    return read_table(spark, f"{name}_now")


def bars_keyed_stream(spark, sf_dir):
    name, location = fresh_table(spark, "keyed")
    create_versioned_table(spark, name, location)
    ingest_keyed(spark, raw_zone(spark, sf_dir), name, fresh_dir(spark, "keyed-checkpoint"), FILES_PER_BATCH)
    return current_rows(spark, name)


def bars_quarantined(spark, sf_dir):
    """Text files with unreadable and missing cells: the bars loaded, and the rows set aside with their reasons."""
    text = raw_bars(spark, sf_dir, by_day=True).select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS])
    volume, price = F.col("volume").cast("double"), F.col("open").cast("double")
    spoilt = text.withColumns(
        {
            "ticker": F.when(~(price > 50000), F.col("ticker")),
            "volume": F.when(volume < 5, F.lit("n/a")).otherwise(F.col("volume")),
        }
    )
    root = write_day_files(
        spoilt, utc_date("cast(window_start as bigint)"), fresh_dir(spark, "spoilt"), clustered=True
    )
    name, aside = bars_table(spark, "checked"), fresh_table(spark, "aside")[0]
    load_checked(spark, root, name, aside)
    good = read_table(spark, name).select(
        F.lit("GOOD").alias("status"), F.col("trade_date").alias("file_day"), "ticker", "window_start",
        "transactions", F.lit(None).cast("string").alias("reasons"),
    )
    cells = F.from_json("row", "ticker string, window_start string, transactions string").alias("cells")
    bad = read_table(spark, aside).select("file_day", cells, "reasons").select(
        F.lit("BAD").alias("status"), "file_day", "cells.ticker",
        F.col("cells.window_start").cast("long").alias("window_start"),
        F.col("cells.transactions").cast("long").alias("transactions"), F.array_join("reasons", "; ").alias("reasons"),
    )
    return good.unionByName(bad)


def backfill_resumed(spark, sf_dir):
    """A backfill of some months, and one of all months that leaves out what the first has done."""
    root = raw_zone(spark, sf_dir)
    name, ledger = bars_table(spark, "resumed"), fresh_table(spark, "finished")[0]
    months = _month_list(spark, sf_dir, root)
    resumable_backfill(spark, months.filter(F.col("end_date") < SOME_DAYS[0]), name, ledger, at_once=60)
    done = resumable_backfill(spark, months, name, ledger, at_once=60)
    per_month = read_table(spark, name).groupBy(F.trunc("trade_date", "month").alias("month"))
    loaded = per_month.agg(F.count("*").alias("loaded"))
    return done.withColumn("month", F.trunc("start_date", "month")).join(loaded, "month", "left").select(
        "month", "status", "bars", "resumed", F.coalesce("loaded", F.lit(0)).cast("long").alias("loaded")
    )


QUERIES = {
    f.__name__: f
    for f in (
        metrics_52w,
        metrics_52w_repeated_days,
        metrics_52w_daily_impacted,
        metrics_52w_both_sides,
        metrics_52w_full_flag_only,
        metrics_upsert,
        metrics_table,
        daily_update_metrics,
        bars_normalized,
        bars_dedup_latest,
        bars_date_range,
        bars_text_normalized,
        bars_text_load,
        bars_text_days,
        bars_csv_roundtrip,
        bars_csv_pruned,
        bars_load,
        bars_overwrite_partitions,
        bars_append,
        bars_volume_widened,
        bars_upsert_jdbc,
        bars_load_counters,
        bars_load_totals,
        bars_incremental_stream,
        orders_upsert,
        orders_duplicate_keys,
        staging_manifest,
        staging_summary,
        staging_days_by_status,
        raw_file_keys,
        range_list,
        range_bar_counts,
        backfill_range_counts,
        backfill_table,
        profile_count,
        profile_sample,
        profile_inferred,
        profile_whole,
        bars_exact_file,
        bars_late_rows,
        bars_restated,
        bars_late_by_ledger,
        bars_refreshed,
        metrics_new_days,
        staging_split_days,
        backfill_bad_range,
        table_properties,
        date_requests,
        metrics_bucketed,
        metrics_versions,
        bars_keyed_stream,
        bars_quarantined,
        backfill_resumed,
    )
}
