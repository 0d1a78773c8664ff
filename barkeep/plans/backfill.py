"""Backfill of many date ranges in one job.

A range that fails does not stop the others: only rows of good ranges are written.
"""

import re
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barkeep.operators.normalize import (
    PERMISSIVE,
    STRICT,
    has_unreadable_cell,
    normalize_text,
    normalize_typed,
)
from barkeep.schema import FILE_DAY, FINISHED
from barkeep.scratch import stage
from barkeep.sinks.tables import OVERWRITE_PARTITIONS, create_bars_table, latest_by_day, write_table
from barkeep.sources.ledger import file_versions
from barkeep.sources.raw_files import (
    SCHEME,
    comparable,
    full_path,
    large_days,
    list_files,
    path_exists,
    scan_bars,
    scan_text,
)

SUCCEEDED = "SUCCEEDED"
FAILED = "FAILED"

# At most this many (file, range) pairs, about 200 bytes each, go to every executor.
MAX_BROADCAST_PAIRS = 500_000

RESULT = T.StructType(
    [
        T.StructField("range_id", T.IntegerType()),
        T.StructField("input_path", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("files", T.LongType()),
        T.StructField("bars", T.LongType()),
        T.StructField("unreadable", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


@dataclass(frozen=True)
class _Item:
    range_id: int
    input_path: str
    start_date: object
    end_date: object
    root: str


def _outermost(items):
    """Input paths that are not below another one, so that no file is scanned twice."""
    kept = []
    for item in sorted(items, key=lambda i: i.root + "/"):
        if not (kept and (item.root + "/").startswith(kept[-1].root + "/")):
            kept.append(item)
    return [i.input_path for i in kept]


def _by_range(spark, items, files):
    """``files`` (with ``path``) once for each range below whose path they lie, with range_id, start_date and end_date."""
    ranges = spark.createDataFrame(
        [(i.range_id, i.start_date, i.end_date, i.root) for i in items],
        "range_id int, start_date date, end_date date, root string",
    )
    steps = F.split(comparable("path"), "/")
    above = F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/")
    )
    return files.withColumn("root", F.explode(above)).join(ranges, "root").drop("root")


def _files_by_range(spark, items, roots):
    """(path, range_id, start_date, end_date): the files below each range's path."""
    return _by_range(spark, items, list_files(spark, roots).select("path"))


def backfill(spark, ranges, table, mode=PERMISSIVE, one_header=True):
    """Load every range of ``ranges`` (range_id, input_path, start_date, end_date).

    A range fails if no file lies below its path, if its files cannot be read (a header
    that differs, a corrupt file) or, in ``strict`` mode, if one of its rows has a cell
    that cannot be read. All ranges are read together; only if that fails are the ranges of the file at fault set
    apart, or, where that does not help, the list halved, until the failing ranges stand alone. Where ranges share a day, the last
    good one that has bars on it decides, as if the ranges were loaded in order.
    Returns one row per range with its status, files, bars, unreadable rows and error.
    """
    if mode not in (PERMISSIVE, STRICT):
        raise ValueError(f"unknown parse mode: {mode}")
    items = _items(spark, ranges)
    create_bars_table(spark, table)
    present = [i for i in items if path_exists(spark, i.input_path)]

    files, counts, errors, read = {}, {}, {}, []
    for group, error in _isolated(spark, present, mode, one_header):
        if error is not None:
            errors[group.range_id] = error
            continue
        files.update(group.files)
        counts.update(group.counts)
        read.append(group.rows)

    results, good = [], []
    for i in items:
        bars, unreadable = counts.get(i.range_id, (0, 0))
        error = errors.get(i.range_id)
        if error is None and not files.get(i.range_id):
            error = f"no files below {i.input_path}"
        if error is None and unreadable:
            error = f"{unreadable} rows with cells that cannot be read"
        if error is None:
            good.append(i)
        results.append(
            (i.range_id, i.input_path, i.start_date, i.end_date, FAILED if error else SUCCEEDED,
             files.get(i.range_id, 0), bars, unreadable, error)
        )
    if good:
        bars = reduce(DataFrame.unionByName, read).filter("in_range").join(_ids(spark, good), "range_id", "left_semi")
        if _share_days(good):
            bars = _last_range_per_day(bars)
        bars = latest_by_day(bars, large_days(spark, _outermost(good)))
        write_table(bars, table, OVERWRITE_PARTITIONS, None)
    return spark.createDataFrame(results, RESULT)


def _items(spark, ranges):
    # The work list is control data: the driver needs its paths to plan the scan.
    return [
        _Item(r.range_id, r.input_path, r.start_date, r.end_date, full_path(spark, r.input_path))
        for r in ranges.collect()
    ]


@dataclass(frozen=True)
class _Read:
    rows: DataFrame
    files: dict
    counts: dict


def _read(spark, items, mode, one_header):
    """The rows of some ranges, staged, with files, bars and unreadable rows per range."""
    roots = _outermost(items)
    pairs = stage(_files_by_range(spark, items, roots), "backfill-files")
    per_range = pairs.groupBy("range_id").agg(F.count("*").alias("files"))
    files = {r.range_id: r.files for r in per_range.collect()}
    rows = stage(_rows_by_range(spark, roots, pairs, mode, one_header), "backfill-rows")
    per_range = rows.groupBy("range_id").agg(
        F.count_if(F.col("in_range")).alias("bars"),
        F.count_if(F.col("unreadable")).alias("unreadable"),
    )
    return _Read(rows, files, {r.range_id: (r.bars, r.unreadable) for r in per_range.collect()})


def _holding_named(items, problem):
    """Ranges below whose path the file lies that the error names; none if it names none of theirs."""
    named = [re.sub(SCHEME, r"\1:/", path.rstrip(".")) for path in re.findall(r"[a-z0-9]+:/+\S+", str(problem))]
    return [i for i in items if any(path.startswith(i.root + "/") or path == i.root for path in named)]


def _isolated(spark, items, mode, one_header, named=False):
    """(what was read, None) for ranges read together, (range, error text) for those that fail alone.

    ``named``: a range was just set apart because the error named one of its files.
    """
    if not items:
        return
    try:
        yield _read(spark, items, mode, one_header), None
        return
    except (PySparkException, Py4JJavaError, ValueError) as problem:
        if spark.sparkContext._jsc.sc().isStopped():
            raise  # the cluster is lost, not a range
        if len(items) == 1:
            yield items[0], str(problem).strip().split("\n")[0]
            return
        bad = [] if named else _holding_named(items, problem)
    if 0 < len(bad) < len(items):
        # As a rule one file is at fault: all other ranges are read at once. If they fail again, they are halved.
        yield from _isolated(spark, bad, mode, one_header)
        yield from _isolated(spark, [i for i in items if i not in bad], mode, one_header, named=True)
        return
    half = len(items) // 2
    yield from _isolated(spark, items[:half], mode, one_header)
    yield from _isolated(spark, items[half:], mode, one_header)


def _ids(spark, items):
    # As small as the work list, which the driver holds: no shuffle of the rows to meet it.
    return F.broadcast(spark.createDataFrame([(i.range_id,) for i in items], "range_id int"))


def _rows_by_range(spark, roots, pairs, mode, one_header):
    """Normalised rows of all files, once per range their file belongs to, marked
    ``in_range`` (to be loaded) or ``unreadable`` (fails the range)."""
    small = pairs.count() <= MAX_BROADCAST_PAIRS
    pairs = F.broadcast(pairs) if small else pairs
    carried = ("unreadable", "range_id", "start_date", "end_date")
    if mode == STRICT:
        raw = scan_text(spark, roots, one_header=one_header, with_path=True)
        marked = raw.join(pairs, "path").withColumn("unreadable", has_unreadable_cell())
        rows = normalize_text(marked, PERMISSIVE, carried, keep_undated=True)
    else:
        raw = scan_bars(spark, roots, with_path=True)
        marked = raw.join(pairs, "path").withColumn("unreadable", F.lit(False))
        rows = normalize_typed(marked, carried)
    # A row without a readable date counts for its file's day, or for every range.
    day = F.coalesce("trade_date", FILE_DAY)
    covered = F.coalesce(day.between(F.col("start_date"), F.col("end_date")), F.lit(True))
    return (
        rows.filter(covered)
        .withColumn("in_range", F.col("trade_date").isNotNull())
        .drop("start_date", "end_date")
    )


def _share_days(items):
    ordered = sorted((i.start_date, i.end_date) for i in items)
    return any(after[0] <= before[1] for before, after in zip(ordered, ordered[1:]))


def _last_range_per_day(bars):
    owners = bars.groupBy("trade_date").agg(F.max("range_id").alias("range_id"))
    return bars.join(owners, ["trade_date", "range_id"], "left_semi")


def create_finished_table(spark, finished, location=None):
    """The table that remembers finished ranges, if it does not exist yet."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FINISHED)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {finished} ({columns}) USING parquet{where}")


def _states(spark, items, mode):
    """What a range was asked for and found, per range_id: its days, and every file version below its path."""
    present = [i for i in items if path_exists(spark, i.input_path)]
    versions = {}
    if present:
        files = file_versions(spark, _outermost(present)).drop("path").withColumnRenamed("uri", "path")
        of_file = F.xxhash64("path", "length", "modified")
        # Sums and exclusive ors do not depend on the order: no list of files is gathered.
        per_range = _by_range(spark, present, files).groupBy("range_id").agg(
            F.count("*").alias("files"), F.bit_xor(of_file).alias("one"), F.bit_xor(F.xxhash64(of_file)).alias("two")
        )
        versions = {r.range_id: f"{r.files} {r.one} {r.two}" for r in per_range.collect()}
    return {
        i.range_id: f"{i.root} {i.start_date} {i.end_date} {mode} {versions.get(i.range_id, 'none')}" for i in items
    }


def _unfinished(items, states, done):
    """Ranges to be loaded, in order: those not finished, and later ones that share a day with such a range."""
    left = []
    for i in sorted(items, key=lambda i: i.range_id):
        shares = any(i.start_date <= j.end_date and j.start_date <= i.end_date for j in left)
        if shares or states[i.range_id] not in done:
            left.append(i)
    return left


def resumable_backfill(spark, ranges, table, finished, mode=PERMISSIVE, one_header=True, at_once=12):
    """``backfill`` in groups of ``at_once`` ranges, each noted in the table ``finished`` after its write.

    Begun again with the same list, after it broke off or after files came, were replaced or went, it loads
    only what is not finished: ranges that failed, ranges with other files or days than before,
    and, as the last good range decides a day, the later ranges that share a day with one of these.
    Use one ``finished`` table for each table. Returns the rows of ``backfill`` for all ranges; ``resumed`` marks
    those left out because they were finished.
    """
    if at_once < 1:
        raise ValueError("a group needs a range")
    create_finished_table(spark, finished)
    create_bars_table(spark, table)
    items = _items(spark, ranges)
    states = _states(spark, items, mode)
    asked = spark.createDataFrame([(s,) for s in states.values()], "state string")
    known = spark.table(finished).join(asked, "state", "left_semi")
    known = known.groupBy("state").agg(F.max_by(F.struct("files", "bars"), "finished_at").alias("found"))
    done = {r.state: r.found for r in known.collect()}
    left = _unfinished(items, states, done)
    results = [
        (i.range_id, i.input_path, i.start_date, i.end_date, SUCCEEDED, found.files, found.bars, 0, None, True)
        for i in items
        if i not in left
        for found in [done[states[i.range_id]]]
    ]
    for at in range(0, len(left), at_once):
        group = left[at : at + at_once]
        listed = [(i.range_id, i.input_path, i.start_date, i.end_date) for i in group]
        listed = spark.createDataFrame(listed, "range_id int, input_path string, start_date date, end_date date")
        loaded = backfill(spark, listed, table, mode, one_header).collect()
        results += [(*r, False) for r in loaded]
        good = [(states[r.range_id], r.files, r.bars) for r in loaded if r.status == SUCCEEDED]
        if good:
            rows = spark.createDataFrame(good, "state string, files long, bars long")
            rows = rows.withColumn("finished_at", F.current_timestamp()).coalesce(1)
            rows.write.mode("append").insertInto(finished)
    return spark.createDataFrame(results, T.StructType([*RESULT, T.StructField("resumed", T.BooleanType())]))
