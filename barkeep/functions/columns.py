"""Column expressions; all of them are built-in functions, none is a Python UDF."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

NANOS_PER_SECOND = 1_000_000_000
SECONDS_PER_DAY = 86_400


def utc_date(nanos):
    """Calendar day (UTC) of a column of epoch nanoseconds, given by name.

    Integer arithmetic only: dividing by 1e9 as a double rounds the last
    nanoseconds of a day into the next one. No time zone is involved, so the
    result does not depend on the session.
    """
    # Rounded down, also before 1970: the remainder is taken off first.
    seconds = f"(({nanos} - pmod({nanos}, {NANOS_PER_SECOND}L)) div {NANOS_PER_SECOND}L)"
    midnight = f"({seconds} - pmod({seconds}, {SECONDS_PER_DAY}L))"
    return F.expr(f"date_from_unix_date(cast({midnight} div {SECONDS_PER_DAY}L as int))")


def day_number(date_column):
    """Days since 1970-01-01: the integer key the range frames walk on."""
    return F.unix_date(F.col(date_column))


def blank_to_null(name):
    """Empty text counts as missing; nothing is trimmed."""
    return F.nullif(F.col(name), F.lit(""))


def lenient_cast(name, data_type):
    """Typed value, or NULL where the text cannot be read as that type."""
    return blank_to_null(name).try_cast(data_type)


def unreadable(name, data_type):
    """True where there is text but it cannot be read as that type.

    Spark reads ``1.5d`` and ``1.5f`` as numbers; databases and the file format do not.
    """
    refused = lenient_cast(name, data_type).isNull()
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        refused = refused | F.col(name).rlike(r"[0-9.]\s*[dDfF]\s*$")
    return blank_to_null(name).isNotNull() & refused


def strict_cast(name, data_type):
    """Typed value; text that cannot be read fails the query, ANSI mode or not."""
    complaint = F.concat(F.lit(f"column {name}: cannot read '"), F.col(name), F.lit("'"))
    return F.when(unreadable(name, data_type), F.raise_error(complaint)).otherwise(
        lenient_cast(name, data_type)
    )


def day_in_file_name():
    """Day in the name of the file a row was read from (``YYYY-MM-DD*``), else NULL."""
    return F.substring(F.col("_metadata.file_name"), 1, 10).try_cast("date")


def raw_key(prefix, date_column):
    """Relative path of a day's raw file, as a column."""
    day = F.col(date_column)
    # Fixed value: the directory and file naming of the raw zone.
    layout = "'/year='yyyy'/month='MM'/'yyyy-MM-dd'.csv.gz'"
    return F.concat(F.lit(prefix.strip("/")), F.date_format(day, layout))


def fixed_width_first(df, keys):
    """Keys in the order that sorts fastest: text last, where fewer rows compare it."""
    return sorted(keys, key=lambda k: isinstance(df.schema[k].dataType, T.StringType))
