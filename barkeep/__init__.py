"""End-of-day market bars on Spark: load, deduplicate, upsert, 52-week extremes."""
