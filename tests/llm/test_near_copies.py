"""Near copies are found by the links between fingerprints too."""

from pyspark.sql import functions as F

from barkeep.llm.batches import tidied
from barkeep.llm.simhash import _sketched, near_copies


def test_linked_fingerprints_are_compared_where_no_band_is_shared(spark):
    words = [f"w{i * 7919 % 1009}" for i in range(400)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(f"x{i}" for i in range(400))]
    own = spark.createDataFrame([(i, str(i), t) for i, t in enumerate(texts)], "_id long, _th string, text string")
    prints = own.mapInArrow(
        tidied(lambda batches: _sketched(batches, 5)),
        "_id long, _th string, fp long, node long, keys array<long>, sketch binary",
    )
    # Bands that no two sets share.
    prints = prints.withColumn("keys", F.array("node")).cache()
    head = F.struct(F.col("_id").isNull().alias("none"), "_id", "_th").alias("head")
    found = near_copies(prints, prints.select("node", head, "sketch", "keys"), own, 5)
    ids = {r.node: r._id for r in prints.select("node", "_id").collect()}
    roots = {ids[r.node]: r.root for r in found.collect()}
    assert set(roots) == {0, 1} and roots[0] == roots[1]
