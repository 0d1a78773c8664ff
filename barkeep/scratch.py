"""Shared scratch space for staged tables and stream checkpoints."""

import tempfile
import uuid

_local_roots = {}


def scratch_root(spark):
    """Folder named by ``spark.checkpoint.dir``.

    Where the setting is empty, a local-mode session gets a temporary folder;
    on a cluster that would not be visible to every executor, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="barkeep-")
    return _local_roots[app]


def fresh_dir(spark, label):
    """A path under the scratch root that nothing else uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df, label):
    """Write ``df`` once and return the written rows.

    Cuts the lineage and lets several consumers share one evaluation; unlike a
    cached or locally checkpointed DataFrame it outlives its executors.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
