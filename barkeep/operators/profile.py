"""Quick look at a dataset: schema, a few rows, the row count."""

from dataclasses import dataclass

from pyspark.sql import functions as F


@dataclass(frozen=True)
class Profile:
    schema: str
    sample: list
    rows: int


def json_rows(df, n, order_by=None):
    """The first ``n`` rows as JSON text; with ``order_by`` always the same ones."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))


def profile(df, n=10, order_by=None):
    """Schema tree, ``n`` sample rows as JSON text, and the number of rows."""
    sample = [r.row for r in json_rows(df, n, order_by).collect()]
    return Profile(df.schema.treeString(), sample, df.count())
