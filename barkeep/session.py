"""Session builder with the settings the jobs expect."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # insertInto honours this setting only when it comes from the session.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name, warehouse=None, extra=None):
    """Create (or fetch) a session; ``extra`` wins over the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    return builder.getOrCreate()
