"""Upsert into a partitioned table."""

from pyspark.sql import functions as F

from barkeep.operators.merge import merged, require_unique
from barkeep.schema import BAR_KEY
from barkeep.scratch import stage
from barkeep.sinks.tables import OVERWRITE_PARTITIONS, write_table

# A list of days this long is still small enough to send to every executor.
MAX_BROADCAST_DAYS = 100_000


def upsert_table(table, source, keys=BAR_KEY, partition="trade_date", already_unique=False, staged=False):
    """Update the rows of ``table`` whose key is in ``source``, insert the others.

    ``source`` is staged first: it is evaluated once, and its keys and days can be
    checked before the table is touched. Only partitions that occur in ``source``
    are read and rewritten. ``partition`` is a date column and one of the keys, so
    a key cannot move between partitions. ``already_unique`` vouches for keys that
    do not repeat, as after a dedup, and saves the check; ``staged`` says that ``source`` is written already. Where
    the table has no rows in these partitions, there is nothing to compare, and the source is only written. Running the same upsert again changes
    nothing.
    """
    if partition not in keys:
        raise ValueError(f"partition column {partition} must be one of the keys {keys}")
    spark = source.sparkSession
    if already_unique and spark.table(table).isEmpty():
        write_table(source, table, OVERWRITE_PARTITIONS, partition)
        return
    rows = source.select(*spark.table(table).columns)
    if not staged:
        rows = stage(rows, "upsert")
    if not already_unique:
        require_unique(rows, keys)

    touched = rows.select(partition).distinct()
    span = touched.agg(
        F.min(partition).alias("first"), F.max(partition).alias("last"), F.count("*").alias("n")
    ).first()
    if not span.n:
        return
    if span.n <= MAX_BROADCAST_DAYS:
        touched = F.broadcast(touched)
    target = (
        spark.table(table)
        .filter(F.col(partition).between(F.lit(span.first), F.lit(span.last)))
        .join(touched, partition, "left_semi")
    )
    written = rows if target.isEmpty() else merged(target, rows, keys)
    write_table(written, table, OVERWRITE_PARTITIONS, partition)
