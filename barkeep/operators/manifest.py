"""Which requested days have raw files."""

from pyspark.sql import functions as F

AVAILABLE = "AVAILABLE"
MISSING = "MISSING"
STAGED = "STAGED"
NO_DATA = "NO_DATA"


def staging_manifest(files, days):
    """One row per calendar day: (trade_date, status, files, paths).

    ``files`` holds (trade_date, path); ``paths`` are all files of the day in order.
    """
    per_day = files.groupBy("trade_date").agg(
        F.count("*").alias("files"), F.sort_array(F.collect_list("path")).alias("paths")
    )
    calendar = days.calendar(files.sparkSession)
    return calendar.join(per_day, "trade_date", "left").select(
        "trade_date",
        F.when(F.col("files").isNull(), MISSING).otherwise(AVAILABLE).alias("status"),
        F.coalesce("files", F.lit(0)).cast("long").alias("files"),
        "paths",
    )


def staging_summary(manifest, input_path):
    """One row for the whole request: overall status, the days by status, the paths
    of all their files and the first and last available day. The arrays of days hold
    one entry per requested calendar day at most."""

    def listed(column, status):
        return F.sort_array(F.collect_list(F.when(F.col("status") == status, F.col(column))))

    available = F.when(F.col("status") == AVAILABLE, F.col("trade_date"))
    return manifest.agg(
        F.when(F.count(available) > 0, STAGED).otherwise(NO_DATA).alias("status"),
        listed("trade_date", AVAILABLE).alias("available_dates"),
        listed("trade_date", MISSING).alias("missing_dates"),
        F.sort_array(F.flatten(F.collect_list("paths"))).alias("raw_paths"),
        F.lit(input_path).alias("input_path"),
        F.min(available).alias("daily_start_date"),
        F.max(available).alias("daily_end_date"),
    )


def days_by_status(manifest):
    """(status, days) with the days of each status in order."""
    return manifest.groupBy("status").agg(
        F.sort_array(F.collect_list("trade_date")).alias("days")
    )
