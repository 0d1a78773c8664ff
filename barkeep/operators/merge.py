"""Keyed merge of new rows into existing ones."""

from pyspark.sql import functions as F

from barkeep.functions.columns import fixed_width_first


class DuplicateKeyError(ValueError):
    """Rows to be merged are not unique by key."""


def duplicate_keys(df, keys):
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def require_unique(df, keys, shown=5):
    """Raise with a sample of the keys if any key occurs more than once."""
    sample = duplicate_keys(df.select(*keys), keys).limit(shown).collect()
    if sample:
        listed = "; ".join(
            ", ".join(f"{k}={row[k]}" for k in keys) + f" ({row['rows']} rows)" for row in sample
        )
        raise DuplicateKeyError(f"rows to merge are not unique by key: {listed}")


def merged(target, source, keys):
    """``source`` rows, and the ``target`` rows whose key ``source`` does not have.

    Update if matched, insert otherwise; nothing is deleted.
    """
    kept = target.join(source.select(*keys), fixed_width_first(target, keys), "left_anti")
    return kept.unionByName(source)
