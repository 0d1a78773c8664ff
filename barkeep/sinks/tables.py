"""Catalog tables stored as Parquet, partitioned by trade_date.

Replacing partitions moves them into place one by one: a reader running at the
same time may see some old and some new days.
"""

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from barkeep.operators.dedup import latest_per_key
from barkeep.schema import BAR_KEY, BARS, FILE_DAYS, METRICS

APPEND = "append"
OVERWRITE_PARTITIONS = "overwrite_partitions"


# For the time of a write. The writer option for dynamic overwrite has no effect on
# insertInto, so the session must say it. How many files are written depends on the
# days, not on the tasks, so merging tasks would only open the files one by one. The
# advisory size is where the rebalance splits a large day.
WRITE_SETTINGS = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


@contextmanager
def write_settings(spark):
    before = {key: spark.conf.get(key) for key in WRITE_SETTINGS}
    for key, value in WRITE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def clustered_for_write(df, column):
    """Bring the rows of a partition value together before the write.

    The rebalance hint shuffles by ``column`` and lets adaptive execution split a
    value that is too large for one task. Sorting by ticker inside a value makes the
    files smaller and lets readers skip row groups.
    """
    order = [column] + [c for c in df.columns if c == "ticker" and c != column]
    return df.hint("rebalance", column).sortWithinPartitions(*order)


def write_table(df, table, disposition=OVERWRITE_PARTITIONS, cluster_by="trade_date"):
    """Append to a table or replace the partitions that occur in ``df``.

    Columns are matched by name; a DataFrame without rows leaves the table alone.
    """
    if disposition not in (APPEND, OVERWRITE_PARTITIONS):
        raise ValueError(f"unknown write disposition: {disposition}")
    spark = df.sparkSession
    rows = df.select(*spark.table(table).columns)
    if cluster_by:
        rows = clustered_for_write(rows, cluster_by)
    mode = "append" if disposition == APPEND else "overwrite"
    with write_settings(spark):
        rows.write.mode(mode).insertInto(table)


def latest_by_day(df, parts=None):
    """Bars deduplicated by ticker and day, to be written with ``cluster_by=None``: one shuffle does for both.

    A task holds whole days. ``parts`` (see ``sources.raw_files.large_days``) divides days that are too large for
    that by their tickers.
    """
    if not parts:
        return latest_per_key(df, cluster_by=("trade_date",))
    number = F.create_map(*[F.lit(x) for day in parts.items() for x in day])[F.col("trade_date")]
    part = F.coalesce(F.pmod(F.xxhash64("ticker"), number.cast("long")), F.lit(0).cast("long"))
    return latest_per_key(df.withColumn("_part", part), (*BAR_KEY, "_part"), cluster_by=("trade_date", "_part"))


def write_latest(df, table, disposition=OVERWRITE_PARTITIONS, parts=None):
    """Dedup bars and write them, see ``latest_by_day``."""
    write_table(latest_by_day(df, parts), table, disposition, cluster_by=None)


def _create(spark, table, layout, location, partition="trade_date"):
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in layout)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({partition}){where}"
    )


def create_bars_table(spark, table, location=None):
    """Curated bars, one partition per day, if the table does not exist yet."""
    _create(spark, table, BARS, location)


def create_metrics_table(spark, table, location=None):
    """52-week metrics. Partitioned by day so that an upsert touches few files."""
    _create(spark, table, METRICS, location)


def create_file_days_table(spark, table, location=None):
    """The file day of each bar that a stream has written; small rows, so by month."""
    _create(spark, table, FILE_DAYS, location, "month")


def drop_days(spark, table, days, column="trade_date", at_once=500):
    """Drop the partitions of ``days``, where they exist. The files of an external table stay behind, unseen."""
    for i in range(0, len(days), at_once):
        listed = ", ".join(f"PARTITION ({column} = DATE'{day}')" for day in days[i : i + at_once])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {listed}")


def set_table_properties(spark, table, properties):
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def unset_table_properties(spark, table, names):
    listed = ", ".join(f"'{n}'" for n in names)
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({listed})")


def _described(spark, table, item):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == item)
    found = rows.first()
    return found.data_type if found else None


def _resume(spark, table, widened, before):
    """Bring a widening that broke off to its end, or back to its start; whether it ended."""
    exists = spark.catalog.tableExists
    if not exists(table) and exists(before):
        ended = exists(widened)
        spark.sql(f"ALTER TABLE {widened if ended else before} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {before}")
        return ended
    spark.sql(f"DROP TABLE IF EXISTS {before}")
    spark.sql(f"DROP TABLE IF EXISTS {widened}")
    return False


def widen_column(spark, table, column, data_type, location=None):
    """Change a column's type where it differs; returns whether it did.

    Parquet tables cannot alter a type in place. The rows are written to a new table, which
    then takes the name, the comments and the properties; the old table is kept under
    ``<table>__before`` until the swap is done, and the next call ends a swap that broke off.
    An external table stays external: without ``location`` it moves to a folder beside its
    old one, whose files remain.
    """
    widened, before = f"{table}__widened", f"{table}__before"
    if _resume(spark, table, widened, before):
        return True
    rows = spark.table(table)
    if rows.schema[column].dataType.simpleString() == data_type:
        return False
    if location is None and _described(spark, table, "Type") == "EXTERNAL":
        location = f"{_described(spark, table, 'Location').rstrip('/')}-{uuid.uuid4().hex[:8]}"
    described = spark.catalog.listColumns(table)
    partitioned = [c.name for c in described if c.isPartition]
    comments = {c.name: c.description for c in described if c.description}
    columns = ", ".join(
        f"{f.name} {data_type if f.name == column else f.dataType.simpleString()}"
        + (f" COMMENT {_literal(comments[f.name])}" if f.name in comments else "")
        for f in rows.schema
    )
    by = f" PARTITIONED BY ({', '.join(partitioned)})" if partitioned else ""
    where = f" LOCATION {_literal(location)}" if location else ""
    spark.sql(f"CREATE TABLE {widened} ({columns}) USING parquet{by}{where}")
    kept = {
        r.key: r.value
        for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
        if not r.key.startswith(("spark.sql.", "transient_"))
    }
    if kept:
        set_table_properties(spark, widened, kept)
    converted = rows.withColumn(column, F.col(column).cast(data_type))
    write_table(converted, widened, APPEND, partitioned[0] if partitioned else None)
    spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
    spark.sql(f"ALTER TABLE {widened} RENAME TO {table}")
    spark.sql(f"DROP TABLE {before}")
    return True


def _literal(text):
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
