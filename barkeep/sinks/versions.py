"""Tables in which an upsert adds a version and readers take the newest row of each key.

A versioned table is partitioned by year and version and bucketed by ticker. An upsert
writes its own rows only, as one more version; nothing is read or rewritten. Buckets keep a
ticker's rows of all years and versions together, so taking the newest rows, and windows by
ticker over them, need no shuffle. ``compact`` folds the versions of a year into one.

Readers see a version when its partitions enter the catalog, which happens after all its files
are in place. One writer at a time: versions are numbered by it.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from barkeep.functions.ranges import bounded, parse_day
from barkeep.operators.merge import require_unique
from barkeep.schema import BAR_KEY, BARS
from barkeep.scratch import stage
from barkeep.sinks.tables import write_settings

# Files per year and version; a bucket of a year should stay near 200 MB.
BUCKETS = 64


def create_versioned_table(spark, table, location, layout=BARS, buckets=BUCKETS):
    """A versioned table, if it does not exist yet. It is external: files of dropped versions stay
    for the readers that have begun, until ``location`` is cleaned."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in layout)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, year int, version int) USING parquet"
        " PARTITIONED BY (year, version)"
        f" CLUSTERED BY (ticker) SORTED BY (ticker, trade_date) INTO {buckets} BUCKETS"
        f" LOCATION '{location}'"
    )


def _partitions(spark, table):
    """(year, version) of the partitions in the catalog; a few for every year."""
    listed = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [tuple(int(part.split("=")[1]) for part in row.partition.split("/")) for row in listed]


def _buckets(spark, table):
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return int(described.filter("col_name = 'Num Buckets'").first().data_type)


def _write(rows, table, version):
    spark = rows.sparkSession
    versioned = rows.withColumn("year", F.year("trade_date")).withColumn("version", F.lit(version))
    # The same hash as the buckets': a task has one bucket, so a year gets one file of each.
    dealt = versioned.select(*spark.table(table).columns).repartition(_buckets(spark, table), "ticker")
    with write_settings(spark):
        # Replaces what a write that broke off may have left below this version's folders.
        dealt.write.mode("overwrite").insertInto(table)


def upsert_version(table, source, already_unique=False):
    """Add ``source`` as a version that outdates older rows of its keys; returns its number.

    ``source`` is staged, and must be unique by ticker and day. Without rows it adds no version
    and returns None. ``already_unique`` vouches for the keys and saves staging and the check.
    """
    spark = source.sparkSession
    if not already_unique:
        source = stage(source, "version")
        require_unique(source, BAR_KEY)
    version = max((v for _, v in _partitions(spark, table)), default=0) + 1
    _write(source, table, version)
    added = any(v == version for _, v in _partitions(spark, table))
    return version if added else None


def current_rows(spark, table, start=None, end=None):
    """The newest row of each ticker and day, within the optional date bounds; only their years are read."""
    start, end = (None if d is None else parse_day(d) for d in (start, end))
    rows = spark.table(table)
    if start is not None:
        rows = rows.filter(F.col("year") >= start.year)
    if end is not None:
        rows = rows.filter(F.col("year") <= end.year)
    newest = Window.partitionBy(*BAR_KEY).orderBy(F.col("version").desc())
    ranked = bounded(rows, start, end).withColumn("_newest", F.row_number().over(newest))
    return ranked.filter("_newest = 1").drop("_newest", "year", "version")


def create_current_view(spark, view, table):
    """A view of the newest rows, for SQL."""
    columns = ", ".join(c for c in spark.table(table).columns if c not in ("year", "version"))
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY {', '.join(BAR_KEY)} ORDER BY version DESC) AS _newest"
        f" FROM {table}) WHERE _newest = 1"
    )


def compact(spark, table, most=1):
    """Fold the versions of each year that has more than ``most`` of them; returns these years.

    The folded rows are added as the newest version before the older ones are dropped. As both
    hold the same newest rows, readers see the same at every moment, and a compaction that
    broke off is ended by the next one.
    """
    versions = {}
    for year, version in _partitions(spark, table):
        versions.setdefault(year, []).append(version)
    years = sorted(year for year, found in versions.items() if len(found) > most)
    if not years:
        return []
    newest = Window.partitionBy(*BAR_KEY).orderBy(F.col("version").desc())
    rows = spark.table(table).filter(F.col("year").isin(years))
    rows = rows.withColumn("_newest", F.row_number().over(newest)).filter("_newest = 1")
    _write(rows.drop("_newest"), table, max(map(max, versions.values())) + 1)
    old = [f"PARTITION (year = {year}, version = {v})" for year in years for v in versions[year]]
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(old)}")
    return years
