"""New raw files into a versioned table, with the newest bar of each key in the stream's own state."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from barkeep.operators.dedup import NEWEST_FIRST
from barkeep.operators.normalize import normalize_typed
from barkeep.schema import BAR_COLUMNS
from barkeep.sinks.versions import upsert_version
from barkeep.streaming.ingest import stream_bars

PROGRESS_KEPT = "spark.sql.streaming.numRecentProgressUpdates"

# State on the executors' disks: the default store keeps all of it, and that of the batch before, in their heaps.
STATE_STORE = "spark.sql.streaming.stateStore"
STATE_SETTINGS = {
    f"{STATE_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # For all stores of an executor together, outside its heap; by default each partition's store has its own.
    f"{STATE_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE_STORE}.rocksdb.maxMemoryUsageMB": "256",
    # Every partition's store would take several MB of disk in advance.
    f"{STATE_STORE}.rocksdb.allowFAllocate": "false",
    # Would look up every key once more, for the metric numRowsTotal alone.
    f"{STATE_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}


class LateBarsError(RuntimeError):
    """Bars came later than the stream was told to wait for."""


def newest_bars(rows, late_days=None):
    """The newest bar of each ticker and day of a stream of raw rows, by the order of ``operators.dedup``."""
    bars = normalize_typed(rows).withColumn("day", F.col("trade_date").cast("timestamp"))
    if late_days is not None:
        bars = bars.withWatermark("day", f"{late_days} days")
    newest = bars.groupBy("ticker", "day").agg(F.max(F.struct(*NEWEST_FIRST)).alias("best"))
    found = newest.select("ticker", F.col("day").cast("date").alias("trade_date"), "best.*")
    return found.select(*BAR_COLUMNS)


@contextmanager
def _stream_settings(spark, kept=100_000):
    """All progress is kept, and state goes by ``STATE_SETTINGS``; what the session says of its state itself wins."""
    before = spark.conf.get(PROGRESS_KEPT)
    added = [key for key in STATE_SETTINGS if spark.conf.get(key, "") == ""]
    spark.conf.set(PROGRESS_KEPT, kept)
    for key in added:
        spark.conf.set(key, STATE_SETTINGS[key])
    try:
        yield
    finally:
        spark.conf.set(PROGRESS_KEPT, before)
        for key in added:
            spark.conf.unset(key)


def ingest_keyed(spark, input_path, table, checkpoint, files_per_batch=None, late_days=None):
    """Add the bars of all files not seen before to a versioned table (``sinks.versions``), then stop.

    The bar of the last file day wins, in whichever order files arrive: the state store keeps the newest bar of each
    ticker and day, and a batch writes, as one version, the keys whose bars came with it. So a batch
    costs what it brings, whatever the table's size. A batch repeated after a failure adds
    the same rows once more, which changes nothing. State and files done are in the checkpoint; a checkpoint
    goes on with the kind of state store that it was begun with.

    Without ``late_days`` bars may come as late as they like, and state grows with the keys, on the
    executors' disks (``STATE_SETTINGS``). With it, state of days older than the newest
    by more than that is let go; if a batch then brings a bar of such a day, Spark leaves it out, and the call
    ends with ``LateBarsError`` after its batches are written: load those days by ``load_bars``.
    """

    def add(rows, batch_id):
        # One row a key by the aggregation: nothing to check.
        upsert_version(table, rows, already_unique=True)

    stream = newest_bars(stream_bars(spark, input_path, files_per_batch), late_days)
    with _stream_settings(spark):
        query = (
            stream.writeStream.outputMode("update")
            .foreachBatch(add)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        operators = [o for p in query.recentProgress for o in p["stateOperators"]]
    # Batches write in a session of their own; this one may still know the files before.
    spark.catalog.refreshTable(table)
    late = sum(o["numRowsDroppedByWatermark"] for o in operators)
    if late:
        raise LateBarsError(f"at least {late} tickers' days came more than {late_days} days late and were left out")
    return query
