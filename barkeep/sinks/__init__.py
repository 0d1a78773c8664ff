"""Writers: partitioned tables, keyed upsert, relational database."""
