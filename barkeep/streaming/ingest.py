"""New raw files into the curated table, each file once."""

from pyspark.sql import functions as F

from barkeep.functions.columns import day_in_file_name
from barkeep.operators.dedup import latest_per_key
from barkeep.operators.normalize import normalize_typed
from barkeep.plans.load import refresh_bars
from barkeep.schema import BAR_KEY, FILE_DAY, RAW_COLUMNS, RAW_TYPED
from barkeep.scratch import stage
from barkeep.sinks.tables import APPEND, create_bars_table, create_file_days_table, write_table
from barkeep.sinks.upsert import upsert_table
from barkeep.sources.ledger import described, file_versions, last_loaded, mark_loaded

FILE_DAYS_SUFFIX = "__file_days"


def stream_bars(spark, input_path, files_per_batch=None):
    """Streaming scan of the raw zone with the columns of the batch scan."""
    reader = (
        spark.readStream.schema(RAW_TYPED)
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        # By default files a week older than the newest one seen are skipped without a word.
        .option("maxFileAge", "36500d")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(input_path).select(*RAW_COLUMNS, day_in_file_name().alias(FILE_DAY))


def ingest_new_files(spark, input_path, table, checkpoint, files_per_batch=None, ledger=None):
    """Upsert the bars of all files not seen before, then stop.

    As in a batch load the bar of the last file day wins, in whichever order files
    arrive: a side table, ``<table>__file_days``, keeps the file day of each bar that a
    stream has written. (Bars loaded otherwise have none and give way.)

    The checkpoint remembers the files done. A batch repeated after a failure
    upserts the same rows again, which changes nothing. A file source knows a file by its name
    alone: with a ``ledger`` (see ``sources.ledger``) the days of files that were replaced under their
    name or removed since the last call are reloaded first, without it they go unnoticed.
    """
    create_bars_table(spark, table)
    seen = None
    if ledger is not None:
        refresh_bars(spark, input_path, table, ledger, new_files=False)
        seen = described(spark, file_versions(spark, input_path), ledger)
    side = f"{table}{FILE_DAYS_SUFFIX}"
    create_file_days_table(spark, side)

    def upsert_batch(rows, batch_id):
        session = rows.sparkSession
        newest = latest_per_key(normalize_typed(rows), keep_file_day=True)
        # Files without a day in their name come before all others.
        newest = newest.withColumn(FILE_DAY, F.coalesce(FILE_DAY, F.lit("0001-01-01").cast("date")))
        newest = stage(newest.withColumn("month", F.trunc("trade_date", "month")), "stream-batch")
        span = newest.agg(F.min("month").alias("first"), F.max("month").alias("last")).first()
        known = session.table(side).filter(F.col("month").between(F.lit(span.first), F.lit(span.last)))
        known = known.join(newest.select("trade_date").distinct(), "trade_date", "left_semi")
        known = known.select(*BAR_KEY, F.col(FILE_DAY).alias("known_day"))
        # As a rule a file holds new days, of which nothing is known: then no bar is compared or read again.
        new_days = known.isEmpty()
        accepted = newest
        if not new_days:
            accepted = newest.join(known, list(BAR_KEY), "left").filter(
                F.col("known_day").isNull() | (F.col("known_day") <= F.col(FILE_DAY))
            )
            accepted = stage(accepted, "stream-batch")
        # Bars first: if the second write fails, the repeated batch does both again.
        upsert_table(table, accepted, already_unique=True, staged=True)
        if new_days:
            write_table(accepted, side, APPEND, "month")
        else:
            upsert_table(side, accepted, (*BAR_KEY, "month"), "month", already_unique=True, staged=True)

    query = (
        stream_bars(spark, input_path, files_per_batch)
        .writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if seen is not None:
        # What lay there before the stream began is in the table now; a version that came later is new next time.
        mark_loaded(seen.join(last_loaded(spark, ledger), "path", "left_anti"), ledger)
    # Batches write in a session of their own; this one may still know the files before.
    for written in (table, side):
        spark.catalog.refreshTable(written)
    return query
