"""Column layouts of the raw files, the curated bars and the metrics table."""

from pyspark.sql import types as T

# The column names, their order and the 52-week span are part of
# the file and table formats that existing data and consumers rely on.
RAW_COLUMNS = (
    "ticker",
    "volume",
    "open",
    "close",
    "high",
    "low",
    "window_start",
    "transactions",
)
BAR_COLUMNS = (
    "ticker",
    "trade_date",
    "window_start",
    "volume",
    "open",
    "close",
    "high",
    "low",
    "transactions",
)
EXTREME_COLUMNS = (
    "past_high_52_weeks",
    "past_low_52_weeks",
    "future_high_52_weeks",
    "future_low_52_weeks",
)
SPAN_DAYS = 364

METRIC_COLUMNS = BAR_COLUMNS + EXTREME_COLUMNS
BAR_KEY = ("ticker", "trade_date")

# Day of the file a raw row came from; decides between files, see operators.dedup.
FILE_DAY = "file_day"

# volume is a double everywhere: a bigint would turn fractional volumes into NULL.
_TYPES = {
    "ticker": T.StringType(),
    "trade_date": T.DateType(),
    "window_start": T.LongType(),
    "transactions": T.LongType(),
}


def _layout(columns):
    return T.StructType([T.StructField(c, _TYPES.get(c, T.DoubleType())) for c in columns])


RAW_TYPED = _layout(RAW_COLUMNS)
RAW_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
BARS = _layout(BAR_COLUMNS)
METRICS = _layout(METRIC_COLUMNS)
FILE_DAYS = T.StructType(
    [T.StructField(c, _TYPES[c]) for c in BAR_KEY] + [T.StructField(FILE_DAY, T.DateType()), T.StructField("month", T.DateType())]
)

# A version of a raw file, see sources.ledger.
LEDGER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("rows", T.LongType()),
        T.StructField("days", T.ArrayType(T.DateType())),
        T.StructField("loaded", T.BooleanType()),
        T.StructField("recorded_at", T.TimestampType()),
    ]
)

# Rows set aside by a checked load, see plans.quarantine.
QUARANTINE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("reasons", T.ArrayType(T.StringType())),
        T.StructField(FILE_DAY, T.DateType()),
    ]
)

# A range of a resumable backfill that has been written, see plans.backfill.
FINISHED = T.StructType(
    [
        T.StructField("state", T.StringType()),
        T.StructField("files", T.LongType()),
        T.StructField("bars", T.LongType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
)
