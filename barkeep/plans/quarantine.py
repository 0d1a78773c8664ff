"""A load that sets unreadable rows aside instead of failing on them or blanking their cells."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from barkeep.functions.columns import blank_to_null, unreadable
from barkeep.operators.normalize import PERMISSIVE, normalize_text
from barkeep.schema import FILE_DAY, QUARANTINE, RAW_COLUMNS, RAW_TYPED
from barkeep.scratch import stage
from barkeep.sinks.tables import (
    OVERWRITE_PARTITIONS,
    create_bars_table,
    drop_days,
    write_latest,
    write_table,
)
from barkeep.sources.raw_files import large_days, scan_text

# The whole line, where its number of cells is wrong.
BROKEN = "_broken"
NO_DAY = "0001-01-01"


@dataclass(frozen=True)
class Checked:
    rows_read: int
    rows_aside: int


def create_quarantine_table(spark, table, location=None):
    """Rows set aside, by the day of their file, if the table does not exist yet."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in QUARANTINE)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({FILE_DAY}){where}")


def reasons():
    """Why an all-text row cannot be a bar, one reason per cell; an empty array for a good row."""
    found = []
    for field in RAW_TYPED:
        if field.name in ("ticker", "window_start"):
            found.append(F.when(blank_to_null(field.name).isNull(), F.lit(f"{field.name}: missing")))
        if field.name != "ticker":
            complaint = F.concat(F.lit(f"{field.name}: cannot read "), F.col(field.name))
            found.append(F.when(unreadable(field.name, field.dataType), complaint))
    # The cells of a broken line may stand in the wrong columns: nothing is said about them.
    return F.when(F.col(BROKEN).isNotNull(), F.array(F.lit("wrong number of cells"))).otherwise(
        F.array_compact(F.array(*found))
    )


def checked_rows(raw):
    """Text rows, scanned with ``broken=BROKEN`` and their path, with ``row`` (the line, or the cells as JSON)
    and ``reasons``; the row of a good one is null, as its cells say the same."""
    row = F.coalesce(BROKEN, F.to_json(F.struct(*RAW_COLUMNS)))
    day = F.coalesce(FILE_DAY, F.lit(NO_DAY).cast("date"))
    marked = raw.withColumns({"reasons": reasons(), FILE_DAY: day})
    return marked.withColumn("row", F.when(F.size("reasons") > 0, row))


def load_checked(
    spark, input_path, table, quarantine, days=None, one_header=False, disposition=OVERWRITE_PARTITIONS
):
    """Load the readable rows of raw files into ``table`` and the others, with file and reasons, into ``quarantine``.

    Each row read ends in one of the two (before the dedup), so read rows and rows set aside add up to
    what the load counters say. What an earlier load set aside from a file read now is replaced,
    also where nothing is set aside any more. Files without a day in their name stand under ``NO_DAY``.
    A short or a long line is set aside too; other text loads fill it with nulls or cut it.
    """
    create_bars_table(spark, table)
    create_quarantine_table(spark, quarantine)
    raw = scan_text(spark, input_path, days, one_header=one_header, with_path=True, broken=BROKEN)
    rows = stage(checked_rows(raw), "checked")
    good = F.size("reasons") == 0
    bars = normalize_text(rows.filter(good), PERMISSIVE)
    files = stage(
        rows.groupBy("path", FILE_DAY).agg(F.count("*").alias("read"), F.count_if(~good).alias("aside")), "checked-files"
    )
    write_latest(bars, table, disposition, large_days(spark, input_path))
    _replace(spark, quarantine, files, rows.filter(~good).select(*QUARANTINE.names))
    counted = files.agg(F.sum("read").alias("read"), F.sum("aside").alias("aside")).first()
    return Checked(counted.read or 0, counted.aside or 0)


def _replace(spark, quarantine, files, aside):
    """Rows set aside from ``files`` are ``aside`` from now on; those of other files of their days stay."""
    touched = files.select(FILE_DAY).distinct()
    before = spark.table(quarantine).join(touched, FILE_DAY, "left_semi")
    stay = before.join(files.select("path"), "path", "left_anti").select(*QUARANTINE.names)
    if before.isEmpty():
        write_table(aside, quarantine, cluster_by=FILE_DAY)
        return
    rows = stage(stay.unionByName(aside), "aside")
    write_table(rows, quarantine, cluster_by=FILE_DAY)
    held = before.select(FILE_DAY).distinct()
    gone = held.join(rows.select(FILE_DAY).distinct(), FILE_DAY, "left_anti").collect()
    drop_days(spark, quarantine, [r[FILE_DAY] for r in gone], FILE_DAY)
