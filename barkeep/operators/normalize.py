"""Raw rows to typed bars with a trade date."""

from pyspark.sql import functions as F

from barkeep.functions.columns import (
    blank_to_null,
    lenient_cast,
    strict_cast,
    unreadable,
    utc_date,
)
from barkeep.schema import BAR_COLUMNS, FILE_DAY, RAW_TYPED

PERMISSIVE = "permissive"
STRICT = "strict"


KEY_COLUMNS = ["ticker", "trade_date", "window_start"]


def _dated(typed, carried):
    dated = typed.withColumn("trade_date", utc_date("window_start"))
    return dated.select(*BAR_COLUMNS, *carried)


def _with_file_day(df, carried):
    return [FILE_DAY, *carried] if FILE_DAY in df.columns else list(carried)


def normalize_typed(raw, carried=()):
    """Upper-case tickers, cast, derive the trade date, drop rows without a key.

    ``carried`` names further columns to keep, besides ``file_day``.
    """
    carried = _with_file_day(raw, carried)
    casts = [
        F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_TYPED if f.name != "ticker"
    ]
    typed = raw.select(F.upper(F.col("ticker")).alias("ticker"), *casts, *carried)
    return _dated(typed, carried).dropna(subset=KEY_COLUMNS)


def has_key_text():
    return blank_to_null("ticker").isNotNull() & blank_to_null("window_start").isNotNull()


def has_unreadable_cell():
    """True for an all-text row that ``strict`` parsing refuses."""
    refused = F.lit(False)
    for field in RAW_TYPED:
        if field.name != "ticker":
            refused = refused | unreadable(field.name, field.dataType)
    return has_key_text() & refused


def normalize_text(raw, mode=STRICT, carried=(), keep_undated=False):
    """The same from all-text rows; empty text is NULL.

    ``strict`` fails on text that is not of its column's type, ``permissive``
    turns it into NULL. Rows without ticker or window_start are dropped first,
    so their other cells are not judged. ``keep_undated`` keeps the rows whose
    window_start permissive parsing turned into NULL.
    """
    if mode not in (STRICT, PERMISSIVE):
        raise ValueError(f"unknown parse mode: {mode}")
    cast = strict_cast if mode == STRICT else lenient_cast
    carried = _with_file_day(raw, carried)
    casts = [cast(f.name, f.dataType).alias(f.name) for f in RAW_TYPED if f.name != "ticker"]
    typed = raw.filter(has_key_text()).select(
        F.upper(F.col("ticker")).alias("ticker"), *casts, *carried
    )
    dated = _dated(typed, carried)
    return dated if keep_undated else dated.dropna(subset=KEY_COLUMNS)
