"""Scans of the raw zone: ``<root>/year=YYYY/month=MM/YYYY-MM-DD.csv.gz``.

A scan accepts the root, a directory below it or exact files. Every row carries
``file_day``, the day in the name of its file.
"""

import datetime as dt
import re
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barkeep.functions.columns import day_in_file_name
from barkeep.schema import FILE_DAY, RAW_COLUMNS, RAW_TYPED
from barkeep.scratch import stage


class MissingColumnsError(ValueError):
    """A raw file's header lacks columns the load needs."""


class NoDataError(RuntimeError):
    """No raw file exists for the requested days."""


def read_csv(spark, path, schema=None, header=True, recursive=True):
    """CSV scan. With a schema the header must name the same columns in the same
    order: a mismatch fails the query instead of binding by position."""
    reader = spark.read.option("header", header).option("recursiveFileLookup", recursive)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", not header)
    return reader.csv(path)


def read_inferred(spark, path):
    """CSV scan with column types inferred from the data (one extra pass)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


class FileDays(NamedTuple):
    """Days of file names, either bound optional."""

    start: dt.date | None = None
    end: dt.date | None = None


def within_file_days(days, slack_days=0, undated=False):
    """Predicate on the file name. Spark applies it to the file listing, so files
    of other days are not opened. ``undated`` keeps files not named by a day."""
    name = F.col("_metadata.file_name")
    inside = F.lit(True)
    if days.start is not None:
        first = days.start - dt.timedelta(days=slack_days)
        inside = inside & (name >= F.lit(first.isoformat()))
    if days.end is not None:
        after = days.end + dt.timedelta(days=slack_days + 1)
        inside = inside & (name < F.lit(after.isoformat()))
    return inside | ~name.rlike(r"^\d{4}-\d{2}-\d{2}") if undated else inside


def _origin(with_path):
    origin = [day_in_file_name().alias(FILE_DAY)]
    return origin + [F.col("_metadata.file_path").alias("path")] if with_path else origin


def scan_bars(spark, path, days=None, slack_days=0, with_path=False):
    """Typed raw rows; unparsable cells are NULL.

    ``days`` limits the scan to the files of those days and ``slack_days`` around
    them. Rows of other trade dates inside these files are kept, and bars of those
    days that lie in other files are not seen.
    """
    # All eight columns are selected: the header check covers only columns read.
    rows = read_csv(spark, path, RAW_TYPED)
    if days is not None:
        rows = rows.filter(within_file_days(days, slack_days, undated=True))
    return rows.select(*RAW_COLUMNS, *_origin(with_path))


def _text_reader(spark):
    # A doubled quote stands for a quote inside a quoted cell.
    return (
        spark.read.option("header", True)
        .option("recursiveFileLookup", True)
        .option("escape", '"')
    )


def file_headers(spark, path, days=None, slack_days=0):
    """One row per (header line, file): the lines that name every raw column.

    No bar holds all eight names as cells, so the test finds header lines without
    relying on row order; only those few lines leave the scan.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    if days is not None:
        lines = lines.filter(within_file_days(days, slack_days))
    names_all = F.lit(True)
    for column in RAW_COLUMNS:
        names_all = names_all & F.col("value").rlike(rf'(^|,)"?{column}"?(,|$)')
    return (
        # A plain substring test first: it rejects nearly every line cheaply.
        lines.filter(F.col("value").contains(RAW_COLUMNS[0]) & names_all)
        .select(F.col("value").alias("header"), F.col("_metadata.file_path").alias("path"))
        .distinct()
    )


def list_files(spark, path, days=None, slack_days=0):
    """(trade_date, path) of raw files; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    if days is not None:
        files = files.filter(within_file_days(days, slack_days))
    return files.select(
        day_in_file_name().alias("trade_date"), F.col("_metadata.file_path").alias("path")
    )


# Compressed bytes of a day's files that one task may well load.
DAY_BYTES = 64 << 20


def large_days(spark, path):
    """Days whose files, by their names, are larger than ``DAY_BYTES``, with the number of parts to load them in."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    sizes = files.select(day_in_file_name().alias("trade_date"), F.col("_metadata.file_size").alias("bytes"))
    found = sizes.dropna().groupBy("trade_date").agg(F.sum("bytes").alias("bytes")).filter(F.col("bytes") > DAY_BYTES)
    return {r.trade_date: -(-r.bytes // DAY_BYTES) for r in found.collect()}


def _fail_for(spark, path, header=None):
    header = _text_reader(spark).csv(path).columns if header is None else header
    lacking = [c for c in RAW_COLUMNS if c not in header]
    raise MissingColumnsError(f"{path} starts with {header}; a header with {lacking} is needed")


def scan_text(
    spark, path, days=None, slack_days=0, one_header=False, with_path=False, broken=None
):
    """Raw rows as text, columns bound by the name in each file's own header.

    Extra columns are ignored, short rows are filled with NULL. Files are grouped
    by header line first, because one CSV scan binds all its files alike. Pass
    ``one_header`` where all files are known to share a header: that saves the
    header pass, and a file that differs fails the query. ``broken`` names a column that gets the
    whole line where its cells are too few or too many, and is null elsewhere.
    """
    listing = list_files(spark, path, days, slack_days)
    if one_header:
        first = listing.agg(F.min("path").alias("path")).first().path
        columns = _text_reader(spark).csv(first).columns if first else RAW_COLUMNS
        if set(RAW_COLUMNS) - set(columns):
            _fail_for(spark, first, columns)
        return _text_rows(spark, path, columns, days, slack_days, with_path, broken)

    found = stage(file_headers(spark, path, days, slack_days), "headers")
    bare = listing.join(found, "path", "left_anti").agg(F.min("path").alias("path")).first().path
    if bare:
        _fail_for(spark, bare)
    headers = sorted(r.header for r in found.select("header").distinct().collect())
    if len(headers) < 2:
        columns = _cells(spark, headers[0]) if headers else RAW_COLUMNS
        return _text_rows(spark, path, columns, days, slack_days, with_path, broken)
    # Only where headers differ must the driver name the files of each to its scan.
    parts = []
    for header in headers:
        files = [r.path for r in found.filter(F.col("header") == header).select("path").collect()]
        parts.append(_text_rows(spark, files, _cells(spark, header), None, 0, with_path, broken))
    return reduce(DataFrame.unionByName, parts)


def is_header_mismatch(problem):
    """Whether a scan failed because a file's header is not the one it was told to expect."""
    return isinstance(problem, MissingColumnsError) or "CSV header" in str(problem)


def _cells(spark, header):
    """Names in a header line, by the CSV reader itself: quoted names may hold commas."""
    line = spark.createDataFrame([(header,)], "value string").select(
        F.from_csv("value", F.lit(", ".join(f"c{i} string" for i in range(header.count(",") + 1))),
                   {"escape": '"'}).alias("cells")
    )
    return [cell for cell in line.select("cells.*").first() if cell is not None]


def _text_schema(columns):
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _text_rows(spark, path, columns, days, slack_days, with_path, broken=None):
    reader, extra = _text_reader(spark).option("enforceSchema", False), [broken] if broken else []
    if broken:
        reader = reader.option("columnNameOfCorruptRecord", broken)
    rows = reader.schema(_text_schema([*columns, *extra])).csv(path)
    if days is not None:
        rows = rows.filter(within_file_days(days, slack_days))
    return rows.select(*RAW_COLUMNS, *extra, *_origin(with_path))


def _on_file_system(spark, path):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark, path):
    """Whether a file or directory exists, on whichever file system it names; of a
    pattern, whether anything matches."""
    target, file_system = _on_file_system(spark, path)
    found = file_system.globStatus(target)
    return found is not None and len(found) > 0


def full_path(spark, path):
    """The path with its file system, encoded as in ``_metadata.file_path``, without
    a trailing slash; compare it with ``comparable`` paths."""
    target, file_system = _on_file_system(spark, path)
    text = file_system.makeQualified(target).toUri().toString().rstrip("/")
    return re.sub(SCHEME, r"\1:/", text)


# One slash after the scheme: file:/x and file:///x are the same file.
SCHEME = "^([a-z0-9]+):/+"


def comparable(path_column):
    return F.regexp_replace(path_column, SCHEME, "$1:/")


def read_table(spark, table):
    """Curated or metrics table by its catalog name."""
    return spark.table(table)


def read_ranges(spark, path):
    """Backfill work list: ``{"months": [{input_path, start_date, end_date}]}``.

    ``range_id`` is the position in the list.
    """
    layout = "months array<struct<input_path:string,start_date:date,end_date:date>>"
    listed = spark.read.option("multiLine", True).schema(layout).json(path)
    return listed.select(F.posexplode("months").alias("range_id", "item")).select(
        "range_id", "item.input_path", "item.start_date", "item.end_date"
    )


def monthly_ranges(spark, prefix, days):
    """The work list for a period: a range per month of ``days``, the first and last
    cut at the period's ends, each with the month's directory below ``prefix``."""
    months = F.sequence(
        F.trunc(F.lit(days.start), "month"), F.lit(days.end), F.expr("interval 1 month")
    )
    month = F.col("month")
    below = F.date_format(month, "'/year='yyyy'/month='MM'/'")
    return spark.range(1).select(F.posexplode(months).alias("range_id", "month")).select(
        "range_id",
        F.concat(F.lit(prefix.rstrip("/")), below).alias("input_path"),
        F.greatest(month, F.lit(days.start)).alias("start_date"),
        F.least(F.last_day(month), F.lit(days.end)).alias("end_date"),
    )


def write_ranges(ranges, path):
    """Save a work list in the form ``read_ranges`` reads."""
    item = F.struct("range_id", "input_path", "start_date", "end_date")
    listed = ranges.agg(F.sort_array(F.collect_list(item)).alias("months"))
    without_id = "transform(months, m -> struct(m.input_path, m.start_date, m.end_date))"
    listed.select(F.expr(without_id).alias("months")).coalesce(1).write.json(path)
