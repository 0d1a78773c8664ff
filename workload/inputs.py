"""Bars, raw files and tables derived from the given test tables."""

from pyspark.sql import functions as F

from barkeep.functions.columns import utc_date
from barkeep.operators.dedup import latest_per_key
from barkeep.operators.normalize import normalize_typed
from barkeep.scratch import fresh_dir
from barkeep.sinks.tables import (
    clustered_for_write,
    create_bars_table,
    write_settings,
    write_table,
)

NANOS_PER_DAY = 86_400_000_000_000


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_bars(spark, sf_dir, by_day=False):
    """Raw rows from ``lineitem``: a ticker per supplier, a bar per line item.

    Tickers are lower case on purpose; ship dates are whole days. ``by_day`` brings a day's rows together for
    ``write_day_files`` before they are computed, as line items are smaller than bars.
    """
    price, net = F.col("l_extendedprice"), 1 - F.col("l_discount")
    items = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    if by_day:
        items = items.hint("rebalance", "l_shipdate")
    day = F.unix_date("l_shipdate").cast("long")
    return items.select(
        F.concat(F.lit("s"), F.col("l_suppkey")).alias("ticker"),
        F.col("l_quantity").alias("volume"),
        price.alias("open"),
        (price * net).alias("close"),
        (price * (1 + F.col("l_tax"))).alias("high"),
        (price * net).alias("low"),
        (day * NANOS_PER_DAY + F.col("l_linenumber")).alias("window_start"),
        F.col("l_orderkey").alias("transactions"),
    )


def bars(spark, sf_dir):
    """Normalised and deduplicated bars."""
    return latest_per_key(normalize_typed(raw_bars(spark, sf_dir)))


_trees = {}


def write_day_files(rows, day, root, clustered=False):
    """Write ``rows`` as gzip CSV in the raw zone's layout, by the date column ``day``.

    Spark writes one directory per day; the driver then gives each file the name
    of its day (``-1``, ``-2``… for further files of a day that was split). A file of
    that name is replaced. ``clustered`` rows have been brought together by day already.
    """
    spark = rows.sparkSession
    parts = rows.withColumn("_dir", F.date_format(day, "yyyy-MM-dd"))
    written = fresh_dir(spark, "day-files")
    parts = parts.sortWithinPartitions("_dir", "ticker") if clustered else clustered_for_write(parts, "_dir")
    with write_settings(spark):
        parts.write.partitionBy("_dir").csv(
            written, header=True, compression="gzip"
        )
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    file_system = path(written).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    months = set()
    for folder in file_system.listStatus(path(written)):
        name = folder.getPath().getName()
        if not name.startswith("_dir="):
            continue
        date = name[len("_dir="):]
        month = f"{root}/year={date[:4]}/month={date[5:7]}"
        if month not in months:
            file_system.mkdirs(path(month))
            months.add(month)
        for i, part in enumerate(file_system.listStatus(folder.getPath())):
            suffix = f"-{i}" if i else ""
            file = path(f"{month}/{date}{suffix}.csv.gz")
            if file_system.exists(file):
                file_system.delete(file, False)
            file_system.rename(part.getPath(), file)
    return root


def raw_zone(spark, sf_dir):
    """Raw zone with the day files of all bars; written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _trees:
        rows = raw_bars(spark, sf_dir, by_day=True)
        root = fresh_dir(spark, "raw")
        _trees[key] = write_day_files(rows, utc_date("window_start"), root, clustered=True)
    return _trees[key]


def event_zone(spark, sf_dir):
    """Raw zone with the day files of ``events``, for the manifest."""
    key = (spark.sparkContext.applicationId, sf_dir, "events")
    if key not in _trees:
        rows = table(spark, sf_dir, "events")
        root = fresh_dir(spark, "events")
        _trees[key] = write_day_files(rows, F.col("ts").cast("date"), root)
    return _trees[key]


def bars_table(spark, label, rows=None):
    """Name of a fresh external table of bars, filled with ``rows``."""
    name, location = fresh_table(spark, label)
    create_bars_table(spark, name, location)
    if rows is not None:
        write_table(rows, name)
    return name


def fresh_table(spark, label):
    """An unused table name and a location for it."""
    location = fresh_dir(spark, label)
    return location.rsplit("/", 1)[1].replace("-", "_"), location
