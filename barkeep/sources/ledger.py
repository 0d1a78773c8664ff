"""Ledger of raw file versions: what was seen, which days each holds, what a table was loaded from.

A version is a path with a length and a modification time, so a file replaced under its name is a new
one. Each entry holds the days of the file's bars, which makes the ledger a zone map: a load by date opens
only the files that hold bars of these days, wherever late bars lie. Versions are read once to
be described. (A file replaced within the clock tick of its file system by one of equal length goes unnoticed.)

Entries are only ever appended. ``loaded`` entries also say which version a table was last brought up to
date with; a file that has gone leaves one without days.
"""

from pyspark.sql import functions as F

from barkeep.operators.normalize import normalize_typed
from barkeep.schema import LEDGER
from barkeep.scratch import stage
from barkeep.sources.raw_files import scan_bars

VERSION = ["path", "length", "modified"]
GONE = -1


def create_ledger(spark, ledger, location=None):
    """The ledger's table, if it does not exist yet."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LEDGER)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ledger} ({columns}) USING parquet{where}")


def file_versions(spark, path):
    """(path, uri, length, modified) of the raw files; their contents are not read.

    ``path`` can be read, ``uri`` is how ``_metadata.file_path`` writes it.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        "path",
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_size").cast("long").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _append(entries, ledger):
    entries = entries.withColumn("recorded_at", F.current_timestamp())
    entries.select(*LEDGER.names).coalesce(1).write.mode("append").insertInto(ledger)


def described(spark, versions, ledger):
    """``versions`` with the ``rows`` and ``days`` of their bars; only those new to the ledger are opened."""
    known = spark.table(ledger).filter(F.col("length") != GONE)
    known = known.groupBy(*VERSION).agg(F.max("rows").alias("rows"), F.max("days").alias("days"))
    fresh = stage(versions.join(known, VERSION, "left_anti"), "fresh-files")
    # The scan needs the paths themselves, as the driver lists the files of any scan.
    paths = [r.path for r in fresh.select("path").collect()]
    if paths:
        bars = normalize_typed(scan_bars(spark, paths, with_path=True).withColumnRenamed("path", "uri"), ["uri"])
        # Rows per file and day first: a file of any size sends one row a day.
        per_day = bars.groupBy("uri", "trade_date").agg(F.count("*").alias("n"))
        per_file = per_day.groupBy("uri").agg(
            F.sum("n").alias("rows"), F.array_sort(F.collect_list("trade_date")).alias("days")
        )
        found = fresh.join(per_file, "uri", "left").select(
            *VERSION,
            F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
            F.coalesce("days", F.array().cast("array<date>")).alias("days"),
            F.lit(False).alias("loaded"),
        )
        _append(found, ledger)
        spark.catalog.refreshTable(ledger)
    known = spark.table(ledger).filter(F.col("length") != GONE)
    known = known.groupBy(*VERSION).agg(F.max("rows").alias("rows"), F.max("days").alias("days"))
    return stage(versions.join(known, VERSION).select(*VERSION, "rows", "days"), "described-files")


def paths_holding(described_files, start=None, end=None):
    """Paths of the files with bars between the optional bounds."""
    def inside(day):
        held = F.lit(True)
        if start is not None:
            held = held & (day >= F.lit(start))
        if end is not None:
            held = held & (day <= F.lit(end))
        return held

    return [r.path for r in described_files.filter(F.exists("days", inside)).select("path").collect()]


def last_loaded(spark, ledger):
    """The newest loaded entry of each path that has not gone."""
    loaded = spark.table(ledger).filter("loaded")
    newest = loaded.groupBy("path").agg(F.max(F.struct("recorded_at", "length", "modified", "days")).alias("entry"))
    return newest.select("path", "entry.length", "entry.modified", "entry.days").filter(F.col("length") != GONE)


def changes(spark, described_files, ledger, new_files=True):
    """(entries, days): what a table must still be told of, and the days it concerns.

    Without ``new_files`` only files that were loaded before count: replaced and removed ones.

    ``entries`` are the versions that it was not loaded from, and one ``GONE`` entry for each file that is no
    longer there. ``days`` are those of the new versions, and those that replaced or removed versions held.
    """
    before = last_loaded(spark, ledger)
    fresh = described_files.join(before, VERSION, "left_anti")
    if not new_files:
        fresh = fresh.join(before.select("path"), "path", "left_semi")
    stale = before.join(described_files, VERSION, "left_anti")
    gone = stale.join(described_files, "path", "left_anti").select(
        "path", F.lit(GONE).cast("long").alias("length"), F.lit(0).cast("timestamp").alias("modified"),
        F.lit(0).cast("long").alias("rows"), F.array().cast("array<date>").alias("days"),
    )
    entries = stage(fresh.select(*VERSION, "rows", "days").unionByName(gone), "changed-files")
    days = entries.select("days").union(stale.select("days"))
    days = days.select(F.explode("days").alias("trade_date")).distinct()
    return entries, stage(days, "changed-days")


def mark_loaded(entries, ledger):
    _append(entries.withColumn("loaded", F.lit(True)), ledger)
    entries.sparkSession.catalog.refreshTable(ledger)
