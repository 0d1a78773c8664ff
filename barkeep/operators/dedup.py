"""One row per key, chosen by a total order."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from barkeep.functions.columns import fixed_width_first
from barkeep.schema import BAR_KEY, FILE_DAY

# The last file wins, within a file the newest window_start; the other columns
# only make the choice the same on every run.
NEWEST_FIRST = (
    FILE_DAY,
    "window_start",
    "transactions",
    "volume",
    "high",
    "low",
    "open",
    "close",
)


def latest_per_key(df, keys=BAR_KEY, newest_first=NEWEST_FIRST, keep_file_day=False, cluster_by=None):
    """Keep the first row of each key, ordering by ``newest_first`` descending.

    ``row_number() = 1`` plans as a group limit on both sides of the shuffle: each
    map task sends at most one row per key, however many copies a key has.

    ``cluster_by`` (some of the keys) brings the rows together by these alone, so that what follows by them needs
    no shuffle of its own. A task then holds all rows of a value, copies included.
    """
    if cluster_by is not None:
        df = df.repartition(*cluster_by)
    order = [F.col(c).desc() for c in newest_first if c in df.columns]
    by_key = Window.partitionBy(*fixed_width_first(df, keys)).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(by_key))
    dropped = ["_rank"] if keep_file_day else ["_rank", FILE_DAY]
    return ranked.filter(F.col("_rank") == 1).drop(*dropped)
